"""Exact n-gram Jaccard join with set-relation skipping: block-skipped index lists, answers derived from similar sets.

Shingles have one global order: all but the frequent ones by hash, then the frequent ones from rare to common (the order
decides the work, never the result). Two sets of similarity t or more share a shingle among their first
n - ceil(t * n) + 1, so an inverted index over these prefixes loses no link. The HEAD of a set is its prefix and some
more, which prunes: of the head of a linked set, ``_least_shared`` shingles at least are in other heads. Only sets that pass it go on, so
texts that share a few lines with others end here.

1. Within a list the smallest node is asked first: its answers are computed against the full sets, a star in place of pairs. A set
   that links with it takes it as its leader and remembers its slack, the number of its shingles that the leader lacks.
2. The entries of a list with one leader are a block with ranges of size and position, and blocks skip each other as wholes: by
   size, or by the shingles left after the position. What remains
   is a pair of leaders, whose overlap is computed once, whatever the lists and members that meet there.
3. A member's overlap with a member of another leader is at most that of their leaders plus both slacks. Where this falls short,
   all members are answered at once. The others are compared in blocks, each overlap derived from the leader's
   by the members' differences from it.

Lists are tiled, so that no task holds a list; equal sets are one node; members of the stars and pairs meet in joins by unique
keys that Spark can split. Lists of sets whose heads are mostly shared but which are far apart remain quadratic in tiles of BLOCK entries.

Defined results: null or wordless text has an empty set and is linked with nothing; a repeated id with equal text is one node, with
unlike texts several; a component is named by the smallest id in it; rows with a null id are never linked and keep a null
component; an empty table gives an empty result; very long texts are held whole, a few in a batch; other columns are ignored.
Sets are compared by 64-bit hashes of their shingles and known by a 64-bit digest of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, consecutive, materialize, mix64, release

#: Frequent shingles that go last in the order: the number is the bound of what is broadcast (two numbers each).
FREQUENT = 1 << 17
#: Shingles that a task counts at a time, and the least count in such a block that is reported.
COUNT_BLOCK, LEAST_COUNT = 4_000_000, 4
#: Entries of a tile of a list, and sets of a block that one task compares with another.
BLOCK = 512
#: Pairs of blocks that a task looks at in one step.
PAIRS = 2_000_000


def _prefix(n, percent: int):
    return n - (n * percent + 99) // 100 + 1


def _head(n, percent: int):
    """Shingles of a set that are indexed: its prefix, a tenth more and eight."""
    return np.minimum(n, _prefix(n, percent) + (n + 9) // 10 + 8)


def _least_shared(n: Column, percent: int) -> Column:
    """Least number of a head's shingles that are in other heads, for a set of n with a link.

    The set whose head ends first in the order, of size j, has at most j - head(j) common shingles after it; and j is
    no smaller than percent of n. Both terms grow with j.
    """
    j = F.ceil(n * percent / 100.0)
    return F.least(F.ceil(j * percent / 100.0), F.ceil(j / 10.0) + 9)


def _needed(a, b, percent: int):
    """Least overlap of linked sets of these sizes, rounded down (so that a bound never drops a link)."""
    return (percent * (a + b) / (100.0 + percent)) - 1e-6


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random odd number for every byte (that of a for A, 0 for white space), and whether it is white space."""
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    number = np.random.default_rng(13).integers(0, 2**64, 256, np.uint64) | np.uint64(1)
    number[65:91] = number[97:123]
    number[white] = 0
    return number, white


_NUMBER, _WHITE = _tables()
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """At least n powers of an odd number, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), 0x9E3779B97F4A7C15, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def word_numbers(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lowered: sums of byte numbers times powers, mixed."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8) if text else np.empty(0, np.uint8)
    white = _WHITE[raw]
    at = np.flatnonzero(~white & np.concatenate([[True], white[:-1]])) if len(raw) else np.empty(0, np.int64)
    if not len(at):
        return np.empty(0, np.uint64)
    raw = raw[at[0]:]
    at = at - at[0]
    sizes = np.diff(at, append=len(raw))
    place = np.arange(len(raw)) - np.repeat(at, sizes)
    return mix64(np.add.reduceat(_NUMBER[raw] * _power(int(sizes.max()))[place], at))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words are one shingle, no words give none."""
    h = word_numbers(text)
    if not len(h):
        return h.view(np.int64)
    width = min(k, len(h))
    n = len(h) - width + 1
    s = np.full(n, width, np.uint64)
    for i in range(width):
        s = s * np.uint64(0xD6E8FEB86659FD93) + h[i:i + n]
    return np.unique(mix64(s).view(np.int64))


def _frequent(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, held, size = set(), [], 0

        def report():
            code, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= LEAST_COUNT
            return pd.DataFrame({"code": code[often], "times": times[often]})

        for pdf in batches:
            for text in pdf["text"]:
                s = shingles(text, k)
                digest = xxhash.xxh3_64_intdigest(s.tobytes())
                if len(s) and digest not in seen:  # copies count once in a block
                    seen.add(digest)
                    held.append(s)
                    size += len(s)
                if size >= COUNT_BLOCK:
                    yield report()
                    seen, held, size = set(), [], 0
        if held:
            yield report()
    return run


def _sketches(k: int, percent: int, often):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        codes, ranks = often.value
        for pdf in batches:
            n, hi, lo, heads = [], [], [], []
            for text in pdf["text"]:
                s = shingles(text, k)
                d = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                hi.append(int.from_bytes(d[:8], "little", signed=True))
                lo.append(int.from_bytes(d[8:], "little", signed=True))
                if d in seen or not len(s):
                    heads.append(None)
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(d)
                rank = np.zeros(len(s), np.int64)
                if len(codes):
                    at = np.minimum(np.searchsorted(codes, s), len(codes) - 1)
                    rank = np.where(codes[at] == s, ranks[at], 0)
                heads.append(s[np.argsort(rank, kind="stable")[:_head(len(s), percent)]])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tid": pdf["tid"], "n": n, "hi": hi, "lo": lo, "head": heads})
    return run


def _overlaps(k: int):
    """Pairs with both texts -> pairs with the size of the intersection of their sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = {}

        def of(node, text):
            if node not in sets:
                if len(sets) >= 256:
                    sets.clear()
                sets[node] = shingles(text, k)
            return sets[node]

        for pdf in batches:
            common = [len(np.intersect1d(of(a, x), of(b, y), assume_unique=True))
                      for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"])]
            yield pdf[["a", "b", "n_a", "n_b"]].assign(common=np.array(common, np.int64))
    return run


def _meeting_leaders(percent: int):
    """Tiles of lists, one row a block of entries with one leader -> pairs of leaders whose members may be linked."""
    columns = ["least_n", "most_n", "left", "leader", "own"]

    def meet(rows: pd.DataFrame, ends: np.ndarray) -> Iterator[pd.DataFrame]:
        """Pairs of rows of one tile; ``ends``: for each row, where its tile ends. Some millions of pairs at a time."""
        low, high, left, leader, own = (rows[c].to_numpy() for c in columns)
        diagonal = (rows["i"] == rows["j"]).to_numpy()
        after = ends - np.arange(len(rows)) - 1
        total = np.cumsum(after)
        start = 0
        while start < len(rows):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, "right")))
            many = after[start:stop]
            x = np.repeat(np.arange(start, stop), many)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
            ok = diagonal[x] | (own[x] != own[y])
            x, y = x[ok], y[ok]
            ok = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
            ok &= np.minimum(left[x], left[y]) >= _needed(low[x], low[y], percent)
            a, b = leader[x[ok]], leader[y[ok]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()
            start = stop

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(rest):
                continue
            code, i, j = (rest[c].to_numpy() for c in ("code", "i", "j"))
            cut = np.flatnonzero((code[1:] != code[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            if len(cut):
                whole = int(cut[-1])
                yield from meet(rest.iloc[:whole], np.repeat(cut, np.diff(cut, prepend=0)))
                rest = rest.iloc[whole:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from meet(rest, np.full(len(rest), len(rest)))
    return run


def _derived(k: int, percent: int):
    """Blocks of one leader's members (side 0) against other sets (side 1), with the leader's own text (side 2).

    The overlap of member and other is that of leader and other, less what the member lacks of the leader, plus what it has besides.
    """
    def links(base, rows: pd.DataFrame, of) -> pd.DataFrame:
        mine, others = rows[rows["side"] == 0], rows[rows["side"] == 1]
        y = [of(a, t) for a, t in zip(mine["node"], mine["text"])]
        z = [of(a, t) for a, t in zip(others["node"], others["text"])]
        plus = [np.setdiff1d(s, base, assume_unique=True) for s in y]
        less = [np.setdiff1d(base, s, assume_unique=True) for s in y]
        codes = np.unique(np.concatenate([*plus, *less, base[:0]]))
        inter = np.tile(np.array([len(np.intersect1d(base, s, assume_unique=True)) for s in z], np.float32), (len(y), 1))

        def places(sets):
            size = np.array([len(s) for s in sets])
            flat = np.concatenate([*sets, base[:0]])
            at = np.minimum(np.searchsorted(codes, flat), max(len(codes) - 1, 0))
            hit = codes[at] == flat if len(codes) else np.zeros(len(flat), bool)
            return np.repeat(np.arange(len(sets)), size)[hit], at[hit]

        signed, there = [(*places(plus), 1), (*places(less), -1)], places(z)
        for start in range(0, len(codes), 4096):
            m, q = np.zeros((len(y), 4096), np.float32), np.zeros((len(z), 4096), np.float32)
            for row, at, sign in signed:
                part = (at >= start) & (at < start + 4096)
                m[row[part], at[part] - start] = sign
            part = (there[1] >= start) & (there[1] < start + 4096)
            q[there[0][part], there[1][part] - start] = 1
            inter += m @ q.T
        ny, nz = np.array([len(s) for s in y]), np.array([len(s) for s in z])
        cy, cz = mine["component"].to_numpy(), others["component"].to_numpy()
        near = (100 * inter >= percent * (ny[:, None] + nz[None, :] - inter)) & (cy[:, None] != cz[None, :])
        i, j = np.nonzero(near)
        found = pd.DataFrame({"a": mine["node"].to_numpy()[i], "b": others["node"].to_numpy()[j], "x": cy[i], "y": cz[j]})
        return found.drop_duplicates(["x", "y"])[["a", "b"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {}

        def of(node, text):
            if node not in known:
                if len(known) >= 4 * BLOCK:
                    known.clear()
                known[node] = shingles(text, k)
            return known[node]

        for rows in consecutive(batches, ["leader", "i", "j"]):
            lead = rows[rows["side"] == 2]
            yield links(of(lead["node"].iloc[0], lead["text"].iloc[0]), rows, of)
    return run


def _tiled(rows: DataFrame, key: str, by: str) -> DataFrame:
    """Each row of a list once for every tile it is in: its own block against every block of the list."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("nb"))
    own = rows.join(sizes.hint("merge"), key).withColumn("own", F.pmod(F.xxhash64(by), F.col("nb")).cast("int"))
    return (own.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .withColumn("i", F.least("own", "p")).withColumn("j", F.greatest("own", "p")).drop("p", "nb"))


def _frequent_order(base: DataFrame, k: int):
    """Broadcast (codes sorted, rank of each by count): the most frequent shingles over all documents, FREQUENT at most."""
    counted = (base.select("text").mapInPandas(_frequent(k), "code long, times long").groupBy("code")
               .agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "code").limit(FREQUENT))
    top = counted.toPandas()
    code, times = top["code"].to_numpy(np.int64), top["times"].to_numpy(np.int64)
    rank = np.empty(len(code), np.int64)
    rank[np.lexsort((code, times))] = np.arange(1, len(code) + 1)
    by = np.argsort(code)
    return base.sparkSession.sparkContext.broadcast((code[by], rank[by]))


def _pruned(nodes: DataFrame, percent: int) -> DataFrame:
    """code, node, n, pos: index entries of the sets that can have a link, of codes that two of them share.

    ``nodes``, the largest table of all, is deleted as soon as it has been read.
    """
    entries = nodes.select("node", "n", F.posexplode("head").alias("pos", "code"))
    shared = entries.groupBy("code").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("code")
    left = materialize(entries.join(shared.hint("merge"), "code"), "jj-shared")
    release(nodes)
    able = left.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")).where(
        F.col("c") >= _least_shared(F.col("n"), percent)).select("node")
    stay = left.join(able.hint("merge"), "node")  # sets that fall out take codes with them
    shared = stay.groupBy("code").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("code")
    out = materialize(stay.join(shared.hint("merge"), "code"), "jj-left")
    release(left)
    return out


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: components of all links of ``percent`` similarity or more between the documents' sets."""
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tid", F.xxhash64("text"))
    often = _frequent_order(base, k)
    heads = materialize(base.mapInPandas(_sketches(k, percent, often),
                                         "doc_id long, tid long, n long, hi long, lo long, head array<long>"), "jj-heads")
    sketched = materialize(heads.drop("head"), "jj-sketch")
    full = materialize(heads.where("n > 0 and doc_id is not null").groupBy("hi", "lo", "n")
                       .agg(F.min(F.struct("doc_id", "tid")).alias("first"), F.first("head", ignorenulls=True).alias("head"))
                       .select(F.xxhash64("hi", "lo", "n").alias("node"), "n", "first.doc_id", "first.tid", "head"), "jj-full")
    nodes = materialize(full.drop("head"), "jj-nodes")
    release(heads)
    index = _pruned(full, percent)
    index = index.where(F.col("pos") < F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1)
    wanted = nodes.select("node", "n", "doc_id", "tid").join(index.select("node").distinct().hint("merge"), "node", "left_semi")
    # a null text has no shingles, so nodes always have one; a null id has no node
    have = materialize(base.join(wanted.hint("merge"), ["doc_id", "tid"]).dropDuplicates(["node"]).select("node", "n", "text"), "jj-texts")

    def overlaps(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda x: have.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("text").alias(f"text_{x}"))
        return materialize(pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
                           .mapInPandas(_overlaps(k), "a long, b long, n_a long, n_b long, common long"), name)

    linked = F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent

    # 1. the smallest node of each list is asked; who links with it takes it as leader
    hubs = index.groupBy("code").agg(F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("top")).where("hub.node < top")
    stars = (index.join(hubs.hint("merge"), "code").where(F.col("node") != F.col("hub.node"))
             .where(F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent)
             .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct())
    asked = overlaps(stars, "jj-stars")
    heads = asked.where(linked).select(F.col("a").alias("node")).distinct()
    follow = (asked.where(linked).groupBy(F.col("b").alias("node"))
              .agg(F.min(F.struct("a", (F.col("n_b") - F.col("common")).alias("slack"))).alias("to"))
              .join(heads.hint("merge"), "node", "left_anti").select("node", F.col("to.a").alias("leader"), "to.slack"))
    members = materialize(have.select("node", "n").join(follow, "node", "left").select(
        "node", "n", F.coalesce("leader", "node").alias("leader"), F.coalesce("slack", F.lit(0)).alias("slack")), "jj-members")

    # 2. blocks of the lists that hold more than one leader; the leaders' overlaps
    marked = index.join(members.drop("n"), "node")
    mixed = marked.groupBy("code").agg(F.min("leader").alias("x"), F.max("leader").alias("y")).where("x < y").select("code")
    blocks = (marked.join(mixed.hint("merge"), "code").groupBy("code", "leader")
              .agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max(F.col("n") - F.col("pos")).alias("left")))
    meet = (_tiled(materialize(blocks, "jj-blocks"), "code", "leader").repartition("code", "i", "j").sortWithinPartitions("code", "i", "j")
            .mapInPandas(_meeting_leaders(percent), "a long, b long").distinct())
    known = asked.select("a", "b")
    fresh = materialize(meet.join(known, ["a", "b"], "left_anti"), "jj-meet")
    answers = overlaps(fresh, "jj-answers")
    every = asked.unionByName(answers)
    links = materialize(every.where(linked).select("a", "b"), "jj-links")
    groups = materialize(components(links, "jj-comp"), "jj-groups")

    # 3. pairs of leaders whose members may still be linked: derived overlaps, block against block
    now = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    now = materialize(now, "jj-now")
    teams = now.groupBy("leader").agg(F.max("slack").alias("slack"), F.min("n").alias("least"), F.count(F.lit(1)).alias("size"),
                                      F.first("component").alias("component"))
    team = lambda x: teams.select(F.col("leader").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("slack", "least", "size", "component")])
    open_pairs = (every.join(team("a"), "a").join(team("b"), "b").where("component_a != component_b and size_a + size_b > 2")
                  .where(F.col("common") + F.col("slack_a") + F.col("slack_b") >= _needed(F.col("least_a"), F.col("least_b"), percent)))
    first = (F.col("size_a") > F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    open_pairs = materialize(open_pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("leader"),
                                               F.when(first, F.col("b")).otherwise(F.col("a")).alias("other")).distinct(), "jj-open")
    if not open_pairs.isEmpty():
        own = now.join(open_pairs.select("leader").distinct(), "leader").select("leader", "node", "component")
        rest = (open_pairs.join(now.select(F.col("leader").alias("other"), "node", "component"), "other")
                .select("leader", "node", "component"))

        def count(rows, name):
            return rows.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias(name))

        sizes = materialize(count(own, "ni").join(count(rest, "nj"), "leader"), "jj-sizes")
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        cols = ["leader", "side", "node", "component", "i", "j"]
        rows = (own.join(sizes, "leader").withColumn("side", F.lit(0)).withColumn("i", at("ni")).withColumn("j", spread("nj")).select(*cols)
                .unionByName(rest.join(sizes, "leader").withColumn("side", F.lit(1)).withColumn("j", at("nj")).withColumn("i", spread("ni")).select(*cols))
                .unionByName(sizes.withColumn("side", F.lit(2)).withColumn("node", F.col("leader")).withColumn("component", F.lit(0).cast("long"))
                             .withColumn("i", spread("ni")).withColumn("j", spread("nj")).select(*cols)))
        last = materialize(rows.join(have.select("node", "text").hint("merge"), "node").repartition("leader", "i", "j")
                           .sortWithinPartitions("leader", "i", "j").mapInPandas(_derived(k, percent), "a long, b long").distinct(), "jj-last")
        if not last.isEmpty():
            groups = materialize(components(links.unionByName(last), "jj-comp"), "jj-groups")
    names = (groups.join(nodes.select("node", F.col("doc_id").alias("least")), "node").groupBy("component").agg(F.min("least").alias("name")))
    named = (groups.join(names, "component").select("node", "name"))
    out = (sketched.withColumn("node", F.xxhash64("hi", "lo", "n")).join(named, "node", "left")
           .join(nodes.select("node", F.col("doc_id").alias("least")), "node", "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNotNull(), F.coalesce("name", F.when(F.col("n") > 0, F.col("least")), "doc_id")).alias("component_id")))
    out = materialize(out, "jj-out")
    release(sketched, nodes, index, have, asked, members, fresh, answers, links, now, open_pairs, groups)
    often.unpersist()
    return out
