"""Filling containers of fixed capacity with documents, measured in tokens.

Bounded-space packing: each task keeps a fixed number of open windows per
container kind, puts an item into the one it fits best, and closes the fullest
when it fits none.  A task looks ahead over a fixed number of items and takes
the largest first.  What stays open at a task's end is packed again, as whole
windows, by fewer tasks, until one round of a bounded number of windows is left.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.session import cut

TOKENIZERS = "/opt/tokenizers"
# Tokenizer name -> vocabulary file; other names need a mapping of the caller's.
FILES = {
    "byte_bpe_50k": "byte_bpe_50k.tiktoken",
    "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken",
}
# Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_counts(docs: DataFrame, doc_id: str, text: str, tokenizer: str, *, folder: str = TOKENIZERS, files: Mapping[str, str] = FILES) -> DataFrame:
    """doc_id, n_tokens; NULL and empty texts have none.  The vocabulary (fixed size) is read once and sent to the tasks.

    Raises for a tokenizer without a file.
    """
    spark = docs.sparkSession
    if tokenizer not in files:
        raise ValueError(f"no vocabulary file is known for tokenizer {tokenizer!r}")
    ranks = spark.sparkContext.broadcast(read_ranks(f"{folder}/{files[tokenizer]}"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        enc = tiktoken.Encoding(tokenizer, pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["t"]]
            yield pd.DataFrame({doc_id: b["i"], "n_tokens": n})

    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
    return rows.mapInPandas(run, f"{doc_id} {kind}, n_tokens long")


class Windows:
    """Open windows of one container kind in one task."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free: list[tuple[int, int]] = []  # (free tokens, window), sorted
        self.made = 0

    def put(self, size: int) -> int:
        """Window number for an item of at most the capacity."""
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            room, w = self.free.pop(at)
        else:
            if len(self.free) >= self.limit:
                self.free.pop(0)  # the fullest is closed
            room, w = self.capacity, self.made
            self.made += 1
        if room > size:
            insort(self.free, (room - size, w))
        elif size == 0:
            insort(self.free, (room, w))
        return w


def _pack(batches: Iterator[pd.DataFrame], level: str, limit: int, lookahead: int) -> Iterator[pd.DataFrame]:
    """Columns kind, capacity, item, size -> kind, item, window, free (tokens left in a window that stays open; -1 in the rows of items)."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    kinds: dict[int, Windows] = {}
    held: list[pd.DataFrame] = []
    placed: list[tuple] = []
    n = 0

    def flush() -> None:
        rows = pd.concat(held, ignore_index=True).sort_values(["kind", "size", "item"], ascending=[True, False, True], kind="stable")
        held.clear()
        for kind, cap, item, size in zip(rows["kind"], rows["capacity"], rows["item"], rows["size"]):
            w = kinds.setdefault(kind, Windows(int(cap), limit)).put(int(size))
            placed.append((kind, item, f"{level}.{part}.{w}"))

    def out() -> pd.DataFrame:
        rows = pd.DataFrame(placed, columns=["kind", "item", "window"]).assign(free=-1)
        placed.clear()
        return rows

    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= lookahead:
            flush()
            n = 0
            yield out()
    if held:
        flush()
        yield out()
    # what stays open: one row per window, without an item
    rest = [(k, "", f"{level}.{part}.{w}", room) for k, ws in kinds.items() for room, w in ws.free]
    if rest:
        yield pd.DataFrame(rest, columns=["kind", "item", "window", "free"])


def pack(sizes: DataFrame, specs: DataFrame, *, doc_id: str, limit: int = 256, lookahead: int = 8192, fan_in: int = 32) -> DataFrame:
    """Containers of every document for every spec.

    sizes: doc_id, tokenizer, n_tokens (NULL counts as 0).  specs: spec_id,
    tokenizer, capacity_tokens > 0.  Result: spec_id, doc_id, piece_no, container_id,
    token_from, token_to.  Only a document above the capacity is split: into full
    pieces, which fill containers of their own, and a rest, which is packed like a
    document.  Documents without tokens go into some container; repeated rows are
    packed each.  Every token of every document is in exactly one container.
    limit, lookahead: open windows and items looked ahead per task and spec.
    """
    kind = sizes.schema[doc_id].dataType.simpleString()
    cap = F.col("capacity_tokens").cast("long")
    n = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0))
    full = F.greatest(F.floor((F.col("n") - 1) / F.col("cap")), F.lit(0)).cast("long")
    items = sizes.join(specs.filter("capacity_tokens > 0"), "tokenizer").select(
        F.col("spec_id").cast("long").alias("kind"), cap.alias("cap"), F.col(doc_id).cast("string").alias("doc"), n.alias("n")
    )
    items = items.withColumn("full", full).withColumn("u", F.monotonically_increasing_id())
    items = cut(items, "items")
    parts = items.filter("full > 0").select("kind", "cap", "doc", "u", F.posexplode(F.sequence(F.lit(1), F.col("full"))).alias("piece_no", "x"))
    whole = parts.select(
        "kind", "doc", "piece_no", F.concat_ws(".", F.lit("full"), "u", "piece_no").alias("container_id"),
        (F.col("piece_no") * F.col("cap")).alias("token_from"), ((F.col("piece_no") + 1) * F.col("cap")).alias("token_to"),
    )
    rest = items.select("kind", F.col("cap").alias("capacity"), F.col("u").cast("string").alias("item"), (F.col("n") - F.col("full") * F.col("cap")).alias("size"))

    schema = "kind long, item string, window string, free long"
    tasks = max(1, rest.rdd.getNumPartitions())
    level = 0
    queue = rest
    links = []
    capacity = specs.select(F.col("spec_id").cast("long").alias("kind"), cap.alias("capacity")).distinct()
    while True:
        name = f"w{level}"
        packed = cut(queue.mapInPandas(lambda it, name=name: _pack(it, name, limit, lookahead), schema), "packed")
        links.append(packed.filter("free < 0").select("kind", "item", "window"))
        if tasks == 1:
            break
        tasks = max(1, -(-tasks // fan_in))
        level += 1
        # an open window is an item of the tokens it holds
        left = packed.filter("free >= 0").join(capacity, "kind")
        queue = left.select("kind", "capacity", F.col("window").alias("item"), (F.col("capacity") - F.col("free")).alias("size")).repartition(tasks, F.xxhash64("window"))
        queue = cut(queue, "open")
        queue = queue.coalesce(tasks)
    where = links[0]
    for up in links[1:]:
        up = up.select("kind", F.col("item").alias("window"), F.col("window").alias("upper"))
        where = where.join(up, ["kind", "window"], "left").select("kind", "item", F.coalesce("upper", "window").alias("window"))
    own = items.join(where, (items["kind"] == where["kind"]) & (items["u"].cast("string") == where["item"])).select(
        items["kind"], "doc", F.col("full").cast("int").alias("piece_no"), F.col("window").alias("container_id"),
        (F.col("full") * F.col("cap")).alias("token_from"), F.col("n").alias("token_to"),
    )
    both = own.unionByName(whole.withColumn("piece_no", F.col("piece_no").cast("int")))
    return both.select(
        F.col("kind").cast("int").alias("spec_id"), F.col("doc").cast(kind).alias(doc_id), "piece_no",
        F.concat_ws(":", F.col("kind").cast("string"), "container_id").alias("container_id"), "token_from", "token_to",
    )


def packed_documents(docs: DataFrame, specs: DataFrame, *, doc_id: str, text: str, folder: str = TOKENIZERS, files: Mapping[str, str] = FILES, **options) -> DataFrame:
    """Measure and pack; the tokenizer names of the specs (a handful) are collected."""
    sizes = None
    for r in sorted(specs.select("tokenizer").distinct().collect()):
        one = token_counts(docs, doc_id, text, r[0], folder=folder, files=files).withColumn("tokenizer", F.lit(r[0]))
        sizes = one if sizes is None else sizes.unionByName(one)
    if sizes is None:
        sizes = docs.select(doc_id, F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("tokenizer")).limit(0)
    return pack(cut(sizes, "sizes"), specs, doc_id=doc_id, **options)


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: containers, tokens and the share of used space."""
    per = packed.groupBy("spec_id").agg(F.countDistinct("container_id").alias("n_containers"), F.sum(F.col("token_to") - F.col("token_from")).alias("n_tokens"))
    per = per.join(specs.select("spec_id", "capacity_tokens"), "spec_id")
    return per.select("spec_id", "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"))


def packing_faults(packed: DataFrame, docs: DataFrame, specs: DataFrame, doc_id: str) -> DataFrame:
    """What a packing must not have, per spec: columns spec_id, n_docs, n_lost, n_overfull, n_broken, n_split.

    n_docs: distinct documents.  n_lost: documents in no container.  n_overfull:
    containers above the capacity.  n_broken: documents whose parts don't follow on
    one another from 0.  n_split: documents split although they fit.
    """
    p = packed.join(specs.select("spec_id", "capacity_tokens"), "spec_id")
    over = p.groupBy("spec_id", "container_id").agg((F.sum(F.col("token_to") - F.col("token_from")) > F.max("capacity_tokens")).alias("bad"))
    over = over.groupBy("spec_id").agg(F.count(F.when(F.col("bad"), 1)).alias("n_overfull"))
    own = p.groupBy("spec_id", doc_id).agg(
        F.min("token_from").alias("first"), F.max("token_to").alias("last"), F.sum(F.col("token_to") - F.col("token_from")).alias("size"), F.count("*").alias("parts"),
        F.max("capacity_tokens").alias("cap"), F.count_distinct("token_from").alias("starts"),
    )
    broken = (F.col("first") != 0) | (F.col("last") != F.col("size")) | (F.col("starts") != F.col("parts"))
    own = own.groupBy("spec_id").agg(
        F.count("*").alias("n_packed"), F.count(F.when(broken, 1)).alias("n_broken"), F.count(F.when((F.col("parts") > 1) & (F.col("size") <= F.col("cap")), 1)).alias("n_split")
    )
    n = docs.agg(F.count_distinct(doc_id).alias("n_docs")).withColumn("one", F.lit(1))
    out = specs.select("spec_id", F.lit(1).alias("one")).join(n, "one").join(over, "spec_id", "left").join(own, "spec_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("spec_id", "n_docs", (F.col("n_docs") - F.coalesce("n_packed", F.lit(0))).alias("n_lost"), zero("n_overfull"), zero("n_broken"), zero("n_split"))
