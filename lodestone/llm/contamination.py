"""Held-out passages inside a corpus: a positional inverted index of the corpus, probed from the
rarest terms of each held-out sentence.

1. The held-out sentences are tokenised; they are a fixed set, so their terms are a small table.
2. Every corpus text is tokenised whole; postings (term, document, position) are kept for the
   held-out terms, and document counts per term come from the same index.
3. For each sentence the lists of its rarest terms are intersected after subtracting the term's
   place in the sentence: postings of one occurrence fall on (nearly) the same offset.
4. Where enough rare terms agree, the postings around the place give the words that stand there;
   they are aligned exactly with the sentence (longest common subsequence), which decides.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.folding import invisible, letter_table
from lodestone.session import bounded_rows, cut, drop_path, spread, work_path

_TABLE = str.maketrans(letter_table() | {c: None for c in invisible()})
_TAG = re.compile(r"<[^<>]*>|&[a-z]{2,8};|&#\d{1,6};")
_WORD = re.compile(r"[^\W_]+")
# Opening lines that tell how to use a passage.
INSTRUCTION = re.compile(r"(?i)\b(passage|question|instruction|answer|below|following)\b")


def words(text: str) -> list[str]:
    """Words of a text without case, accents, markup, invisible or look-alike characters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_TABLE))
        text = "".join(c for c in text if not unicodedata.combining(c)).translate(_TABLE)
    return _WORD.findall(_TAG.sub(" ", text).lower())


def sentences(text: str, least_words: int = 5) -> list[list[str]]:
    """Whole sentences of a held-out passage as words, without an instruction line at its head.

    A sentence of fewer than ``least_words`` words is no passage: texts share it by chance.
    """
    parts = [x for x in re.split(r"(?<=[.!?])[\"”')\]]*\s+|\n+", text.strip()) if x.strip()]
    if parts and len(parts) > 1 and INSTRUCTION.search(parts[0]) and len(words(parts[0])) <= 14:
        parts = parts[1:]
    return [w for p in parts if len(w := words(p)) >= least_words]


def _edit_one(a: str, b: str) -> bool:
    """Whether two words are one edit apart (insert, delete, replace or swap)."""
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 5:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    x, y = a[k:], b[k:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])


def align(sentence: list[str], window: list[str]) -> tuple[int, int, int]:
    """Longest common subsequence of a sentence and a window: (words matched, first, last place
    in the window). Words one edit apart match; of equal matches the tightest is taken."""
    n = len(window)
    # best[j]: (matched, -span, start) of an alignment that ends at or before window place j
    best: list[tuple[int, int, int, int]] = [(0, 0, -1, -1)] * (n + 1)
    for w in sentence:
        prev = best[0]
        for j in range(1, n + 1):
            here = best[j]
            x = window[j - 1]
            if x == w or (x[:1] == w[:1] or x[1:2] == w[1:2]) and _edit_one(x, w):
                start = prev[2] if prev[0] else j - 1
                new = (prev[0] + 1, -(j - 1 - start), start, j - 1)
                if new[:2] > here[:2]:
                    here = new
            prev = best[j]
            best[j] = max(here, best[j - 1], key=lambda t: t[:2])
    m = best[n]
    return m[0], m[2], m[3]


def carries(sentence: list[str], window: list[str], vocabulary: frozenset[str], share: float = 0.78, conflicts: int = 1) -> bool:
    """Whether a window carries a whole sentence, a few words of it changed.

    ``share`` of the words must stand there in order. A changed word is a sign of alteration; if
    the words put in their place belong to the held-out vocabulary themselves, more than
    ``conflicts`` of them are a sign of another text in the same manner.
    """
    matched, first, last = align(sentence, window)
    if matched < share * len(sentence):
        return False
    if matched >= 0.93 * len(sentence):
        return True
    # Words of the window that no alignment uses: walk again inside the span.
    left = defaultdict(int)
    for w in sentence:
        left[w] += 1
    foreign = 0
    for w in window[first : last + 1]:
        if left[w] > 0:
            left[w] -= 1
        elif w in vocabulary:
            foreign += 1
    return foreign <= conflicts


def held_out(items: DataFrame, max_items: int = 200_000) -> list[tuple[int, int, list[str]]]:
    """(item_id, sentence number, words) of a held-out set of at most ``max_items`` rows."""
    rows = bounded_rows(items.select("item_id", "text").where("item_id is not null and text is not null"), max_items, "the held-out set")
    return [(r["item_id"], k, w) for r in rows for k, w in enumerate(sentences(r["text"]))]


def build_index(documents: DataFrame, path: str) -> DataFrame:
    """The positional inverted index (term, doc_id, positions) of whole texts, stored at ``path``.

    It is built in segments: every task writes the postings of its documents sorted by term, so
    no text is shuffled, a term's postings are found by the statistics of row groups, and new
    documents are added by writing further segments. Null texts and ids have no postings.
    """
    docs = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, ids, places = [], [], []
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                at: dict[str, list[int]] = {}
                for p, w in enumerate(words(text)):
                    at.setdefault(w, []).append(p)
                terms += at
                places += at.values()
                ids += [doc] * len(at)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(ids, pa.int64()), pa.array(places, pa.list_(pa.int32()))], ["term", "doc_id", "positions"])

    index = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(postings, "term string, doc_id bigint, positions array<int>")
    index.sortWithinPartitions("term").write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.parquet(path)


def leaks(documents: DataFrame, items: DataFrame, rare_terms: int = 8, agree: int = 4, slack: int = 4, share: float = 0.78, index: DataFrame | None = None) -> DataFrame:
    """(doc_id, item_id): documents that carry at least one whole sentence of an item's passage.

    At least ``rare_terms`` of each sentence, the rarest by corpus document count, are looked up in
    the index (built here unless given) and intersected after subtracting their places: ``agree``
    of them must lie within ``slack`` words of their places. A long sentence takes more terms, so
    that ``share`` of its words unchanged leave enough of them, wherever the changes fall. Then the
    postings of the places around the match tell its words, which decide (``carries``); no text is
    read again. Changed case, punctuation, spacing, markup and characters do not matter, and up
    to about a fifth of a sentence's words may differ. Null texts and ids take no part; equal rows
    give one result; empty inputs an empty one. Tables are broadcast only by their size.
    """
    spark = documents.sparkSession
    probe = held_out(items)
    if not probe:
        return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("item_id")).where("false")
    own = work_path(spark, "postings") if index is None else None
    if index is None:
        index = build_index(documents, own)
    vocabulary = sorted({w for _, _, ws in probe for w in ws})
    held_terms = spark.createDataFrame([(w,) for w in vocabulary], "term string")
    counts = index.join(held_terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    df = {r["term"]: r["df"] for r in bounded_rows(counts, len(vocabulary), "the held-out terms")}
    lookup: list[tuple[str, int, int, int]] = []
    needs: list[tuple[int, int, int]] = []
    for n, (_, _, ws) in enumerate(probe):
        changed = len(ws) - math.ceil(share * len(ws))
        rare = sorted(range(len(ws)), key=lambda k: (df.get(ws[k], 0), -len(ws[k]), k))[: min(62, max(rare_terms, changed + agree))]
        needs.append((n, max(1, min(agree, len(ws) // 3)), len(ws) + len(ws) // 3 + 3 * slack))
        lookup += [(ws[k], n, k, bit) for bit, k in enumerate(rare)]
    terms = spark.createDataFrame(lookup, "term string, sentence int, place int, bit int")
    needed = spark.createDataFrame(needs, "sentence int, need int, span int")
    # Offsets of one occurrence differ by at most `slack`: they share a cell of one of two grids.
    wide = 2 * slack
    hits = index.join(terms, "term").select("doc_id", "sentence", "place", "bit", F.explode("positions").alias("p"))
    hits = hits.select("doc_id", "sentence", "bit", (F.col("p") - F.col("place")).alias("offset"))
    cells = F.explode(F.array((F.floor(F.col("offset") / wide) * 2).cast("int"), (F.floor((F.col("offset") + slack) / wide) * 2 + 1).cast("int")))
    agreed = hits.select("doc_id", "sentence", "offset", F.expr("shiftleft(1L, bit)").alias("bit"), cells.alias("cell"))
    agreed = agreed.groupBy("doc_id", "sentence", "cell").agg(F.bit_or("bit").alias("bits"), F.min("offset").alias("at"))
    agreed = agreed.where(F.bit_count("bits") >= min(x for _, x, _ in needs)).join(needed, "sentence").where(F.bit_count("bits") >= F.col("need"))
    # Cells of both grids that tell one place share a window.
    places = agreed.groupBy("doc_id", "sentence", F.floor(F.col("at") / wide)).agg(F.min("at").alias("lo"), (F.max("at") + F.max("span")).alias("hi"))
    places = cut(places.select("doc_id", "sentence", F.greatest(F.col("lo") - slack, F.lit(0)).alias("lo"), "hi"))
    # The words around each match, from the postings of its document.
    near = index.join(places.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "term", F.explode("positions").alias("p"))
    near = near.join(places, "doc_id").where("p between lo and hi")
    windows = near.groupBy("doc_id", "sentence", "lo").agg(F.array_sort(F.collect_list(F.struct("p", "term"))).alias("w"))
    content = frozenset(w for w in vocabulary if len(w) > 3)
    shared = spark.sparkContext.broadcast((probe, content))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vocab = shared.value
        for b in batches:
            out_d, out_i = [], []
            for doc, n, w in zip(b["doc_id"].to_pylist(), b["sentence"].to_pylist(), b["w"].to_pylist()):
                item, _, sentence = held[n]
                if carries(sentence, [x["term"] for x in w], vocab, share):
                    out_d.append(doc)
                    out_i.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(out_d, pa.int64()), pa.array(out_i, pa.int64())], ["doc_id", "item_id"])

    found = cut(windows.select("doc_id", "sentence", "w").mapInArrow(decide, "doc_id bigint, item_id bigint").distinct())
    if own:
        drop_path(spark, own)
    return found
