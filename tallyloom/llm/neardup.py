"""Near duplicates by an inverted join of MinHash coordinates, confirmed on whole shingle sets.

Texts with equal shingle sets form a class; a class is one node, so exact copies never meet
each other. Every class is posted under its coordinate-value pairs. Two sets that agree in at
least ``matches`` of ``coordinates`` pairs share one of the first ``coordinates - matches + 1``
pairs of either, in a common order (prefix); with the order by rising document frequency, pairs
that only one class has come first and need no posting, and frequent ones are skipped. At
similarity 0.8 the default (14 of 32) misses a link with a probability of about 2e-6.

Within a posting list nothing is paired with everything. In each of a few rounds every open
list (one with several components) names a hub, a member of its largest component; each class
outside that component counts its collisions with hubs and confirms the best one on the full
sets, and links make larger components. Last, what is still in different components is
compared: classes outside the largest component with the rest of their list, dealt out in
blocks of a bounded size, which count collisions, also of a longer signature, and take a pair
in the first list that both share. A block's sets are then fetched once each and its pairs
confirmed on them, but for those that its links already connect. So the result does not depend
on the rounds, and what comes out of a block is links, not pairs.

Defined cases: a null text, or one without words, has no shingles and links with nothing; a
text with fewer words than a shingle is one shingle. Of rows that share an id each is a
document of its own text; identical rows are copies. Null ids never name a component that has
another id. An empty table gives no rows. Texts of any length are read whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.words import blocks, distinct_per_text, mix, sequence_hash
from tallyloom.session import freeze

COORDINATES, MATCHES = 32, 14
# A second signature, of one byte per coordinate, for the classes that meet at all. At similarity
# 0.8 it agrees in 410 of 512 on average (sd 9); 45 less are asked for.
FINE, FINE_SLACK = 512, 45
BLOCK = 512
ROUNDS = 3
_SEED = 0x2545F4914F6CDD1D


def shingle_sets(texts: pa.Array, k: int, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block of texts: first row, texts, distinct shingle hashes of all texts, their bounds."""
    for block in blocks(texts, lower):
        at, hashes = block.windows(k)
        doc = np.searchsorted(block.first, at, "right") - 1
        words = np.diff(block.first)
        short = np.flatnonzero((words > 0) & (words < k))
        whole = sequence_hash(block.hash, block.first[short], words[short])
        doc, hashes = np.append(doc, short), np.append(hashes, whole)
        values, bounds = distinct_per_text(block.texts, doc, hashes)
        yield block.row, block.texts, values, bounds


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_SEED)) | np.uint64(1)


def _per_text(values: np.ndarray, bounds: np.ndarray, reduce: np.ufunc, empty: int = 0) -> np.ndarray:
    out = np.full(len(bounds) - 1, empty, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = reduce.reduceat(values, bounds[:-1][full])
    return out


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """16 bytes per set; equal sets have equal ones. None for an empty set."""
    one = _per_text(mix(values), bounds, np.add)
    two = _per_text(mix(values ^ np.uint64(_SEED)), bounds, np.bitwise_xor)
    n = np.diff(bounds)
    both = np.stack([mix(one + n.astype(np.uint64)), two], 1)
    return [both[i].tobytes() if n[i] else None for i in range(len(n))]


def _sketcher(k: int, lower: bool):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(COORDINATES)
        for batch in batches:
            for row, texts, values, bounds in shingle_sets(batch["text"], k, lower):
                signature = np.stack([_per_text(values * f, bounds, np.minimum) for f in factors], 1).view(np.int64)
                flat = pa.array(signature.ravel(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, texts),
                        batch["key"].slice(row, texts),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(fingerprints(values, bounds), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * COORDINATES, pa.int32()), flat),
                    ],
                    names=["doc_id", "key", "n", "node", "sig"],
                )

    return sketch


def _set_maker(k: int, lower: bool):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(COORDINATES + FINE)[COORDINATES:]
        for batch in batches:
            for row, texts, values, bounds in shingle_sets(batch["text"], k, lower):
                sets = [values[bounds[i] : bounds[i + 1]].tobytes() for i in range(texts)]
                least = [mix(_per_text(values * f, bounds, np.minimum)) for f in factors]
                fine = (np.stack(least, 1) & np.uint64(255)).astype(np.uint8).view(np.int8)
                bytes_of = pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * FINE, pa.int32()), pa.array(fine.ravel(), pa.int8()))
                yield pa.RecordBatch.from_arrays(
                    [batch["node"].slice(row, texts), pa.array(fingerprints(values, bounds), pa.binary()), pa.array(sets, pa.binary()), bytes_of],
                    names=["node", "own", "shingles", "fine"],
                )

    return make


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets reach the similarity."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["sa"], batch["sb"], strict=True):
                linked.append(_similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])

    return confirm


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
    return freeze(joined.mapInArrow(_confirmer(percent), "a binary, b binary"), "links")


def sketches(docs: DataFrame, k: int, lower: bool, id: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return freeze(rows.mapInArrow(_sketcher(k, lower), f"doc_id {kind}, key long, n long, node binary, sig array<long>"), "sketches")


def links(docs: DataFrame, sketched: DataFrame, k: int, lower: bool, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b): similar classes, enough links to connect all that are connected."""
    source = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = sketched.where("n > 0").groupBy("node").agg(F.min(source).alias("source"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = freeze(classes, "classes")
    posted = classes.select("node", F.posexplode("sig").alias("c", "v"))
    counts = posted.groupBy("c", "v").agg(F.count("*").alias("df")).where("df > 1")
    shared = posted.join(freeze(counts, "counts"), ["c", "v"])
    # at most one entry per coordinate; what is not shared precedes it in the common order
    own = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "c", "v"))).alias("list"))
    own = own.where(F.size("list") >= MATCHES).withColumn("list", F.slice("list", 1, F.size("list") - (MATCHES - 1)))
    wanted = own.join(classes, "node").withColumn("mask", F.expr("aggregate(list, 0, (a, x) -> a | shiftleft(1, x.c))"))
    wanted = freeze(wanted, "candidates")

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    ids = wanted.select("node", F.col("source.doc_id").alias("id"), F.col("source.key").alias("key"))
    same = rows["id"].eqNullSafe(ids["id"]) & (rows["key"] == ids["key"])
    # one text per class: rows that agree in id and text combine before the shuffle
    texts = rows.join(ids, same).select("node", "text").dropDuplicates(["node"])
    sets = texts.mapInArrow(_set_maker(k, lower), "node binary, own binary, shingles binary, fine array<tinyint>")
    sets = freeze(sets.where("node = own").drop("own").dropDuplicates(["node"]), "sets")
    postings = freeze(wanted.select("node", F.explode("list").alias("e")).select("node", "e.c", "e.v"), "postings")

    found = None
    named = postings.withColumn("component", F.col("node"))
    for turn in range(ROUNDS):
        hub = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node"))["node"]
        rows = named.join(_open_lists(named), ["c", "v"])
        hubs = freeze(rows.where("component = main").groupBy("c", "v").agg(hub.alias("hub")), "hubs")
        met = rows.where("component != main").join(hubs, ["c", "v"]).groupBy("node", "hub").agg(F.count("*").alias("m"))
        best = met.groupBy("node").agg(F.max(F.struct("m", "hub"))["hub"].alias("hub"))
        new = _confirmed(best.select(F.col("hub").alias("a"), F.col("node").alias("b")), sets, percent)
        found = new if found is None else found.union(new)
        labels = components(found)
        named = postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = freeze(named, "named")

    rest = named.join(_open_lists(named), ["c", "v"])
    signed = wanted.select("node", "n", "sig", "mask").join(sets.select("node", "fine"), "node")
    rest = rest.join(signed, "node")
    blocks_of = F.ceil(F.col("all") / BLOCK).cast("int")
    place = F.pmod(F.xxhash64("node"), blocks_of).cast("int")
    spread = F.explode(F.sequence(F.lit(0), blocks_of - 1))
    # every row meets the rows outside the main component in one of the blocks of its list
    fields = [*_BLOCK, "side", "node", "n", "component", "main", "sig", "mask", "fine"]
    left = rest.withColumns({"i": place, "j": spread, "side": F.lit(0)}).select(*fields)
    right = rest.where("component != main").withColumns({"j": place, "i": spread, "side": F.lit(1)}).select(*fields)
    met = _in_blocks(left.union(right), "side").mapInArrow(_blockwise(lambda rows: _collide(rows, percent), _MET), _ddl(_MET))
    met = freeze(met, "met")
    holders = met.where("partners is null").drop("partners").join(sets.select("node", "shingles"), "node")
    listed = met.where("partners is not null").withColumn("shingles", F.lit(None).cast("binary"))
    both = holders.withColumn("partners", F.lit(None).cast("array<binary>")).unionByName(listed)
    last = _in_blocks(both.select(*_BLOCK, "node", "partners", "shingles"), "node").mapInArrow(
        _blockwise(lambda rows: _confirm_block(rows, percent), _LINK), _ddl(_LINK)
    )
    return found.union(freeze(last, "links"))


_BLOCK = ["c", "v", "i", "j"]
_PLACE = [("c", pa.int32()), ("v", pa.int64()), ("i", pa.int32()), ("j", pa.int32())]
_MET = pa.schema([*_PLACE, ("node", pa.binary()), ("partners", pa.list_(pa.binary()))])
_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.binary()): "array<binary>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _in_blocks(rows: DataFrame, order: str) -> DataFrame:
    """Rows of a block together in one task, next to each other; a block has a bounded size."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *_BLOCK).sortWithinPartitions(*_BLOCK, order)


def _blockwise(work, schema: pa.Schema):
    """Calls ``work`` with the rows of one block after the other, as lists of dicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for part in range(0, batch.num_rows, 64) for r in batch.slice(part, 64).to_pylist())
        out = []
        for _, group in itertools.groupby(rows, key=lambda r: (r["c"], r["v"], r["i"], r["j"])):
            out += work(list(group))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _collide(rows: list[dict], percent: int) -> list[dict]:
    """Per left row its partners in other components; and a row without partners for each node that has some."""
    left, right = [r for r in rows if not r["side"]], [r for r in rows if r["side"]]
    if not left or not right:
        return []
    sig = np.array([r["sig"] for r in right], np.int64)
    fine = np.array([r["fine"] for r in right], np.int8)
    mask, n = np.array([r["mask"] for r in right], np.int64), np.array([r["n"] for r in right], np.int64)
    least = int(FINE * (percent / 100 + (1 - percent / 100) / 256)) - FINE_SLACK
    bits = np.left_shift(1, np.arange(COORDINATES))
    numbers = {c: i for i, c in enumerate({r["component"] for r in rows})}
    ranks = {x: i for i, x in enumerate(sorted({r["node"] for r in rows}))}
    component, rank = np.array([numbers[r["component"]] for r in right]), np.array([ranks[r["node"]] for r in right])
    place = {x: rows[0][x] for x in _BLOCK}
    out, seen = [], set()
    for x in left:
        near = 100 * np.minimum(n, x["n"]) >= percent * np.maximum(n, x["n"])
        other = component != numbers[x["component"]]
        if x["component"] != x["main"]:
            other &= rank > ranks[x["node"]]
        at = np.flatnonzero(near & other)
        if not len(at):
            continue
        same = sig[at] == np.array(x["sig"], np.int64)
        # collisions in all coordinates, and the first of those that both have posted
        shared = same & ((mask[at] & x["mask"])[:, None] & bits > 0)
        first = (np.argmax(shared, 1) == place["c"]) & shared.any(1)
        at = at[(same.sum(1) >= MATCHES) & first]
        at = at[(fine[at] == np.array(x["fine"], np.int8)).sum(1) >= least] if len(at) else at
        if len(at):
            partners = [right[k]["node"] for k in at.tolist()]
            out.append(place | {"node": x["node"], "partners": partners})
            seen |= {x["node"], *partners}
    return out + [place | {"node": node, "partners": None} for node in sorted(seen)]


def _confirm_block(rows: list[dict], percent: int) -> list[dict]:
    """Links among a block's pairs, on the full sets; pairs that links of the block already connect are passed over."""
    sets = {r["node"]: np.frombuffer(r["shingles"], np.uint64) for r in rows if r["shingles"] is not None}
    top = {node: node for node in sets}

    def find(x: bytes) -> bytes:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    out = []
    for r in rows:
        for other in r["partners"] or ():
            x, y = find(r["node"]), find(other)
            if x != y and _similar(sets[r["node"]], sets[other], percent):
                top[x] = y
                out.append({"a": r["node"], "b": other})
    return out


def _open_lists(named: DataFrame) -> DataFrame:
    """(c, v, all, main) of the lists that still hold several components; main is the most frequent."""
    parts = named.groupBy("c", "v", "component").agg(F.count("*").alias("n"))
    lists = parts.groupBy("c", "v").agg(
        F.sum("n").alias("all"), F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("main")
    )
    return freeze(lists.where("parts > 1").drop("parts"), "lists")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, lower: bool = True, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, node (its class, null without shingles), key (hash of the text), component (of the class)."""
    sketched = sketches(docs, k, lower, id, text)
    labels = components(links(docs, sketched, k, lower, percent, id, text))
    classes = sketched.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "component").select("node", "component_id", "component")
    # copies may be a third of all rows: their class is a hot key of the side that is split
    full = sketched.where("n > 0").select("doc_id", "key", "n", "node").join(named, "node", "left")
    bare = sketched.where("n = 0").select("doc_id", "key", "n", "node").withColumn("component_id", F.col("doc_id"))
    bare = bare.withColumn("component", F.lit(None).cast(sketched.schema["node"].dataType))
    return full.unionByName(bare).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "node",
        "key",
        "component",
    )
