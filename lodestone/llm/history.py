"""Batches checked against all accepted history through a stored index of minwise band keys.

An item of a record (a page it stands for in one spelling, or its text) is cut into pieces, a
minwise signature is taken over them, and each band of the signature is one key of the index. The
index is a set of tables in the shared folder: band keys with item and signature, one part per
increment and hash bucket; links between stored records that a later increment found to be one;
and a mark for each finished increment. An increment reads the buckets its own keys fall in,
verifies the similarity behind equal keys, and appends its own keys. What is stored is never
written again: an existing index is opened and grows, and history is not processed twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import weburls
from lodestone.llm.components import connected_components
from lodestone.session import bounded_rows, cut, drop_path, work_path

_PRIME = (1 << 31) - 1
#: Characters and words in a piece.
CHARACTERS, WORDS = 5, 5
#: Bands and rows for pages, where only equal ones count, and for texts at a similarity of 0.8:
#: 16 bands of 3 miss one pair in 97,000 at that similarity.
PAGE_BANDS, TEXT_BANDS = (2, 2), (16, 3)
#: A host is shared when names of so many first words, and as many pages, lie on it.
SHARED_NAMES = 20


def pieces(item: str, by_words: bool) -> list[str]:
    """The distinct pieces of an item: runs of five characters, or of five words; a shorter item is one piece."""
    parts = item.split() if by_words else list(item)
    n = WORDS if by_words else CHARACTERS
    glue = " " if by_words else ""
    return list({glue.join(parts[k : k + n]) for k in range(max(1, len(parts) - n + 1))})


def signature(c: Column, bands: tuple[int, int], by_words: bool = False) -> Column:
    """array<bigint>: the minwise signature of an item over its pieces; null stays null."""
    size = bands[0] * bands[1]
    k = np.arange(size, dtype=np.int64)
    a, b = (2 * k + 1) * 7_368_787 % _PRIME, (k + 1) * 104_395_301 % _PRIME

    @F.arrow_udf("array<bigint>")
    def signed(items: pa.Array) -> pa.Array:
        import xxhash

        out = []
        for x in items.to_pylist():
            if x is None:
                out.append(None)
                continue
            h = np.fromiter((xxhash.xxh32_intdigest(p) for p in pieces(x, by_words)), np.int64) % _PRIME
            least = np.full(size, _PRIME, np.int64)
            for at in range(0, len(h), 4096):
                np.minimum(least, ((h[at : at + 4096, None] * a + b) % _PRIME).min(0), out=least)
            out.append(least.tolist())
        return pa.array(out, pa.list_(pa.int64()))

    return signed(c)


def similarity(a: Column, b: Column, by_words: bool) -> Column:
    """Jaccard similarity of the pieces of two items."""

    @F.arrow_udf("double")
    def jaccard(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x.to_pylist(), y.to_pylist()):
            s, t = set(pieces(p, by_words)), set(pieces(q, by_words))
            out.append(1.0 if p == q else len(s & t) / len(s | t))
        return pa.array(out, pa.float64())

    return jaccard(a, b)


def _there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class History:
    """A stored index of items (item, first_id), opened where it exists and appended by increments."""

    def __init__(self, spark: SparkSession, path: str, bands: tuple[int, int] = PAGE_BANDS, by_words: bool = False, buckets: int = 16):
        self.spark, self.path, self.bands, self.by_words = spark, path.rstrip("/"), bands, by_words
        self.buckets = buckets
        if _there(spark, f"{self.path}/made"):  # the stored index knows its buckets
            self.buckets = spark.read.parquet(f"{self.path}/made").first()["buckets"]
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.path}/made")
        marks = self.spark.read.schema("increment int, batch int").parquet(f"{self.path}/done") if _there(spark, f"{self.path}/done") else None
        self.finished = [] if marks is None else [tuple(r) for r in bounded_rows(marks, 1_000_000, "the increments")]

    def done(self) -> list[int]:
        """Numbers of the finished increments; what an unfinished one left is overwritten by its next run."""
        return sorted(k for k, _ in self.finished)

    def last_batch(self) -> int | None:
        """The greatest batch number that is stored."""
        return max((b for _, b in self.finished), default=None)

    def finish(self, increment: int, batch: int) -> None:
        self.spark.createDataFrame([(increment, batch)], "increment int, batch int").coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        self.finished.append((increment, batch))

    def keyed(self, items: DataFrame) -> DataFrame:
        """``items`` with signature, and one row per band with key and bucket."""
        n, r = self.bands
        keys = F.array(*[F.xxhash64(F.lit(j), *[F.col("signature")[k] for k in range(j * r, (j + 1) * r)]) for j in range(n)])
        signed = items.withColumn("signature", signature(F.col("item"), self.bands, self.by_words))
        return signed.withColumn("key", F.explode(keys)).withColumn("bucket", F.pmod("key", F.lit(self.buckets)).cast("int"))

    def append(self, items: DataFrame, links: DataFrame, increment: int) -> None:
        """Store the keys of ``items`` (item, first_id), each item under its smallest id, and ``links`` (src, dst)."""
        if increment in self.done():
            raise ValueError(f"increment {increment} is stored already")
        keyed = self.keyed(items.select("item", "first_id")).repartition("bucket")
        keyed.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/keys/increment={increment}")
        links.select("src", "dst").write.mode("overwrite").parquet(f"{self.path}/links/increment={increment}")

    def links(self) -> DataFrame:
        """(src, dst): all links between stored ids so far."""
        parts = [f"{self.path}/links/increment={k}" for k in self.done()]
        return self.spark.read.schema("src bigint, dst bigint").parquet(*parts) if parts else self.spark.createDataFrame([], "src bigint, dst bigint")

    def probe(self, items: DataFrame, threshold: float) -> DataFrame:
        """(item, stored, first_id): stored items that are at least so similar to one of ``items`` (item).

        Only the buckets that the items' own keys fall in are read. Behind an equal key the
        signatures must agree well enough, then the items themselves are compared.
        """
        schema = "item string, first_id bigint, signature array<bigint>, key bigint, increment int, bucket int"
        parts = [f"{self.path}/keys/increment={k}" for k in self.done()]
        if not parts:
            return items.select("item", F.col("item").alias("stored"), F.lit(0).cast("bigint").alias("first_id")).where("false")
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/keys").parquet(*parts)
        mine = self.keyed(items.select("item").distinct())
        # The partition filter: only buckets of the items' own keys are read.
        wanted = mine.select("bucket").distinct()
        stored = stored.join(F.broadcast(wanted), "bucket", "left_semi").select("key", F.col("item").alias("stored"), F.col("signature").alias("other"), "first_id")
        return self._alike(mine.join(stored, "key"), threshold).select("item", "stored", "first_id")

    def _alike(self, pairs: DataFrame, threshold: float) -> DataFrame:
        if threshold >= 1:
            return pairs.where("signature = other and item = stored").dropDuplicates(["item", "stored", "first_id"])
        size = self.bands[0] * self.bands[1]
        agree = F.size(F.filter(F.zip_with("signature", "other", lambda x, y: x == y), lambda x: x)) / size
        near = pairs.where(agree >= threshold - 3 * (threshold * (1 - threshold) / size) ** 0.5).dropDuplicates(["item", "stored", "first_id"])
        return near.where(similarity(F.col("item"), F.col("stored"), self.by_words) >= threshold)

    def among(self, items: DataFrame, threshold: float) -> DataFrame:
        """(first_id, other_id): pairs of different ``items`` (item, first_id) of one increment that are at least so similar."""
        mine = cut(self.keyed(items.select("item", "first_id")))
        left = mine.select("key", "item", "signature", "first_id")
        right = mine.select("key", F.col("item").alias("stored"), F.col("signature").alias("other"), F.col("first_id").alias("other_id"))
        pairs = left.join(right, "key").where("first_id < other_id")
        return self._alike(pairs, threshold).select("first_id", "other_id")


def pages_of(records: DataFrame, fronts: DataFrame) -> DataFrame:
    """(prep_id, batch_no, item): the pages a record stands for, each once.

    No proof and so left out: what is no web address, a key built on the name only
    (identity_basis name), and the front page of a directory or shared host (``fronts``).
    """
    proven = F.when(F.coalesce(F.lower(F.trim("identity_basis")), F.lit("")) != "name", F.col("identity_key"))
    r = records.select("prep_id", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), F.array("website", "listing_url", proven).alias("urls")).where("prep_id is not null")
    r = r.select("prep_id", "batch_no", F.explode("urls").alias("url")).select("prep_id", "batch_no", weburls.parts(F.col("url")).alias("p")).where("p is not null")
    plain = r.where("not p.front").select("prep_id", "batch_no", F.col("p.page").alias("item"))
    front = r.where("p.front").select("prep_id", "batch_no", F.col("p.page").alias("item"), F.col("p.host").alias("host")).join(fronts, "host", "left_anti").drop("host")
    return plain.union(front).distinct()


def front_hosts(configs: DataFrame, records: DataFrame, *columns: str, name: str = "name") -> DataFrame:
    """(host): hosts whose front page tells nothing of a product: directories of the registry, and
    shared hosts, found from the data: those with pages of at least ``SHARED_NAMES`` first words of
    names, none of which most of its records bear."""
    listed = configs.select(F.explode(F.array("homepage", "listing_url")).alias("u")).select(weburls.parts(F.col("u"))["host"].alias("host")).where("host is not null")
    first = F.regexp_extract(F.lower(F.col(name)), "([\\p{L}\\p{N}]{3,})", 1)
    r = records.select(first.alias("word"), F.explode(F.array(*columns)).alias("u")).select("word", weburls.parts(F.col("u")).alias("p")).where("p is not null and word <> ''")
    by_word = r.groupBy("p.host", "word").agg(F.count("*").alias("n"), F.countDistinct("p.page").alias("pages"))
    shared = by_word.groupBy("host").agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.max("n").alias("top"), F.sum("pages").alias("pages"))
    shared = shared.where((F.col("words") >= SHARED_NAMES) & (F.col("top") * 4 < F.col("n")) & (F.col("pages") >= SHARED_NAMES)).select("host")
    return listed.union(shared).distinct()


def _increments(records: DataFrame, store: History, history_batch: int) -> list[tuple[int, DataFrame, bool]]:
    """(number, rows, is history) of what the store does not hold yet: accepted history, then all later batches."""
    held, at = store.last_batch(), len(store.done())
    batch = F.coalesce("batch_no", F.lit(0))
    out = []
    if held is None:
        out.append((at, records.where(batch <= history_batch), True))
        at, held = at + 1, history_batch
    out.append((at, records.where(batch > held), False))
    return out


def _grouped(store: History, links: DataFrame, olds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, bridges): components over new links and those stored, and links between stored ids that are new."""
    groups = cut(connected_components(links.union(store.links()).where("src <> dst").distinct()))
    bridges = olds.join(groups, F.col("first_id") == F.col("node")).where("component < node").select(F.col("node").alias("src"), F.col("component").alias("dst"))
    return groups, bridges.distinct()


def repeats(records: DataFrame, configs: DataFrame, history_batch: int = 0, path: str | None = None) -> DataFrame:
    """(first_prep_id, prep_id): the rows of later batches that repeat an earlier row.

    Rows are checked against the stored index at ``path`` (a fresh one if none is given) and
    against the earlier rows of their own increment; rows of batches that the index holds are
    not read again. A row repeats another if one of its pages is a page of a row with a smaller
    prep_id; first_prep_id is the earliest row of the product, found through any chain of shared
    pages, also across increments. Copies of a page are reduced to their smallest id before any
    join. Rows without any page repeat nothing; null batch_no counts as history, equal prep_ids
    as one row; an empty table gives an empty result.
    """
    spark = records.sparkSession
    store = History(spark, path or work_path(spark, "history"))
    fronts = cut(front_hosts(configs, records, "website", "listing_url"))
    out = spark.createDataFrame([], "first_prep_id bigint, prep_id bigint")
    for number, rows, is_history in _increments(records, store, history_batch):
        pages = cut(pages_of(rows, fronts).withColumn("prep_id", F.col("prep_id").cast("bigint")))
        by_page = cut(pages.groupBy("item").agg(F.min("prep_id").alias("least"), F.max("batch_no").alias("batch")))
        old = cut(store.probe(by_page.select("item"), 1.0).groupBy("item").agg(F.min("first_id").alias("first_id")))
        known = by_page.join(old, "item", "left").select("item", F.least("least", "first_id").alias("first_id"), "least")
        mine = cut(pages.join(known, "item").select("prep_id", "item", "first_id", "least"))
        links = mine.select(F.col("prep_id").alias("src"), F.col("first_id").alias("dst")).union(mine.select(F.col("prep_id").alias("src"), F.col("least").alias("dst")))
        groups, bridges = _grouped(store, links, old.select("first_id").distinct())
        if not is_history:
            again = mine.where("first_id < prep_id").select("prep_id").distinct()
            found = again.join(groups, F.col("prep_id") == F.col("node")).select(F.col("component").alias("first_prep_id"), "prep_id")
            out = out.union(cut(found))
        store.append(known.join(groups, F.col("first_id") == F.col("node"), "left").select("item", F.coalesce("component", "first_id").alias("first_id")), bridges, number)
        top = by_page.agg(F.max("batch")).first()[0]
        store.finish(number, history_batch if is_history else top if top is not None else history_batch)
    if path is None:
        drop_path(spark, store.path)
    return out


def plain_text(c: Column) -> Column:
    """Words of a text, lower case, parted by one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " "))


def near_repeats(records: DataFrame, threshold: float = 0.8, history_batch: int = 0, path: str | None = None) -> DataFrame:
    """(prep_id, class_id, links): the rows of later batches whose description nearly repeats an accepted one.

    Descriptions are compared by runs of five words at a Jaccard similarity of ``threshold``; a
    row joins the class of all texts linked to its own, directly or through others, and class_id
    is the smallest prep_id of it. ``links`` counts the different texts that are similar to the
    row's own. Copies are one text in the index and in every comparison. Null and blank
    descriptions repeat nothing.
    """
    spark = records.sparkSession
    store = History(spark, path or work_path(spark, "near"), TEXT_BANDS, True)
    out = spark.createDataFrame([], "prep_id bigint, class_id bigint, links bigint")
    for number, rows, is_history in _increments(records, store, history_batch):
        texts = rows.select(F.col("prep_id").cast("bigint").alias("prep_id"), F.coalesce("batch_no", F.lit(0)).alias("batch_no"), plain_text(F.col("observed_description")).alias("item")).where("prep_id is not null and item <> ''")
        texts = cut(texts.distinct())
        items = cut(texts.groupBy("item").agg(F.min("prep_id").alias("first_id"), F.max("batch_no").alias("batch")))
        old = cut(store.probe(items.select("item"), threshold).join(items.select("item", F.col("first_id").alias("mine")), "item"))
        new = cut(store.among(items, threshold))
        links = old.select(F.col("mine").alias("src"), F.col("first_id").alias("dst")).union(new.select("first_id", "other_id"))
        groups, bridges = _grouped(store, links, old.select("first_id").distinct())
        if not is_history:
            other = old.where("item <> stored").select("mine", F.col("first_id").alias("o")).union(new.select("first_id", "other_id")).union(new.select("other_id", "first_id"))
            counts = other.distinct().groupBy("mine").agg(F.count("*").alias("links"))
            named = texts.join(items.select("item", F.col("first_id").alias("mine")), "item").join(groups, F.col("mine") == F.col("node"), "left").join(counts, "mine", "left")
            found = named.select("prep_id", F.coalesce("component", "mine").alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links")).where("class_id < prep_id or links > 0")
            out = out.union(cut(found.distinct()))
        store.append(items.select("item", "first_id"), bridges, number)
        top = items.agg(F.max("batch")).first()[0]
        store.finish(number, history_batch if is_history else top if top is not None else history_batch)
    if path is None:
        drop_path(spark, store.path)
    return out
