"""Linking sightings without a common key: heuristic votes weighed by a generative label model.

Rows are reduced to profiles (name form, site, listing slug), so copies cost nothing. Blocks on
site, name, slug and one-edit neighbourhoods propose pairs of profiles; several matching
functions vote on each pair; a latent-class model with a dependency tree between the functions
(learned by expectation maximisation over the table of vote patterns) gives the posterior
confidence. Accepted pairs are joined to products, and products to pairs of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import weburls
from lodestone.llm.components import connected_components
from lodestone.llm.folding import fold_ascii
from lodestone.llm.history import front_hosts
from lodestone.session import bounded_rows, cut, maybe_broadcast

# Words that names carry beside the name.
NOISE = ("ai", "the", "ltd", "inc", "llc", "gmbh", "app", "beta", "tm", "io", "co", "corp", "hq")
SLUG_NOISE = (*NOISE, "item", "review", "reviews", "tool")
VOTERS = ("site", "name", "slug", "spelling", "host", "tagline", "maker")
#: A maker has one product when so large a share of its rows with a full name bear one form of it.
SOLE = 0.6
#: Rows of a part of a product; a product of more rows is paired part by part.
PART = 2000
#: A table of vote patterns has at most 3 ** voters rows, whatever the data.
MAX_PATTERNS = 3 ** len(VOTERS)


def _tokens(text: Column, noise: tuple[str, ...]) -> Column:
    return F.filter(F.split(text, "[^a-z0-9]+"), lambda x: (x != "") & ~x.isin(*noise))


def name_tokens(name: Column) -> Column:
    """Words of a name in order: folded, tagline and legal form cut off, joined words parted at
    capitals, 'X by Y' turned to 'Y X', version numbers dropped. Null gives null."""
    n = F.regexp_replace(fold_ascii(name), "[™®©]|\\((?i:tm|r|c)\\)", "")
    n = F.regexp_replace(F.trim(n), r"\s+(\||-|–|—|·|»)\s+.*$|:\s.*$", "")
    n = F.regexp_replace(n, r"(?i)[ ,]+(gmbh|ltd|inc|llc|corp|co|s\.?a\.?|tm)\.?$|\.(ai|io|app|com|co)$", "")
    n = F.regexp_replace(n, r"(?i)\s+v?\d+(\.\d+)*$", "")
    t = _tokens(F.lower(F.regexp_replace(n, "([a-z])([A-Z])", "$1 $2")), NOISE)
    at = F.array_position(t, "by").cast("int")
    return F.when((at > 1) & (at < F.size(t)), F.concat(F.slice(t, at + 1, F.size(t)), F.slice(t, F.lit(1), at - 1))).otherwise(t)


def profiles(rows: DataFrame, configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sightings, profiles): row_id, source_key, pid; and one row per distinct profile.

    A profile has first (first word), squash (words joined), sorted (words sorted and joined),
    words, site (the page of the website, null where it is missing or a front page that tells
    nothing), host, slug and slug_sorted, tagline, n (rows), branded. A name is branded if it
    says whose product it is: its words stand in the websites of the rows that carry them;
    everyday names do not. Rows that have neither a branded name nor a site can't be told apart
    from others and stay alone.
    """
    fronts = cut(front_hosts(configs, rows, "website", "listing_url"))
    fronts = maybe_broadcast(fronts, fronts.count()).select(F.col("host").alias("_host"), F.lit(True).alias("_told"))
    p = weburls.parts(F.col("website"))
    q = weburls.parts(F.col("listing_url"))
    blank = lambda c: F.nullif(F.trim(fold_ascii(F.col(c))), F.lit(""))
    r = rows.select("row_id", "source_key", F.col("name").alias("raw"), p.alias("p"), q.alias("q"), blank("tagline").alias("tagline")).where("row_id is not null")
    last = F.element_at(F.split(F.col("q.path"), "/"), -1)
    slug = F.coalesce(_tokens(fold_ascii(last), SLUG_NOISE), F.array().cast("array<string>"))
    slug = F.filter(slug, lambda x: x.rlike("[a-z]{3}") & ~x.rlike("[0-9]"))
    words = F.coalesce(name_tokens(F.col("raw")), F.array().cast("array<string>"))
    r = r.withColumn("slugs", slug).withColumn("words", words)
    r = r.withColumn("words", F.when(F.size("words") == 0, F.slice("slugs", 1, 2)).otherwise(F.col("words")))
    r = r.join(fronts, F.col("p.front") & (F.col("p.host") == F.col("_host")), "left")
    front = F.coalesce("_told", F.lit(False))
    r = r.select(
        "row_id",
        "source_key",
        "tagline",
        "words",
        F.try_element_at("words", F.lit(1)).alias("first"),
        F.array_join("words", "").alias("squash"),
        F.array_join(F.array_sort("words"), " ").alias("sorted"),
        F.when(~front, F.col("p.page")).alias("site"),
        F.when(~front, F.col("p.host")).alias("host"),
        F.nullif(F.array_join("slugs", ""), F.lit("")).alias("slug"),
        F.nullif(F.array_join(F.array_sort("slugs"), " "), F.lit("")).alias("slug_sorted"),
    )
    key = ["squash", "sorted", "site", "slug_sorted", "slug"]
    r = cut(r.withColumn("pid", F.xxhash64(*[F.coalesce(k, F.lit("\0")) for k in key])))
    one = r.groupBy("pid").agg(F.count("*").alias("n"), F.max("tagline").alias("tagline"), *[F.first(c).alias(c) for c in (*key, "host", "words", "first")])
    # Which words are found in the websites of the rows that carry them?
    told = one.where("site is not null").select("n", "words", F.regexp_replace("site", "[^a-z0-9]", "").alias("s"))
    told = told.select("n", F.explode("words").alias("word"), "s").where("length(word) >= 3")
    words = told.groupBy("word").agg(F.sum(F.when(F.contains("s", "word"), F.col("n")).otherwise(0)).alias("pro"), F.sum("n").alias("all"))
    everyday = words.where("pro * 2 < all and all >= 2").select("word")
    names = one.select("squash", F.explode("words").alias("word"))
    plain = names.join(everyday, "word", "left_semi").select("squash").distinct().withColumn("plain", F.lit(True))
    one = one.join(plain, "squash", "left").withColumn("branded", F.col("plain").isNull() & (F.length("squash") >= 4)).drop("plain")
    # Has a maker one product? By the share of its most frequent full name.
    forms = one.where("branded and size(words) > 1 and first is not null").groupBy("first", "sorted").agg(F.sum("n").alias("n"))
    makers = forms.groupBy("first").agg((F.max("n") >= SOLE * F.sum("n")).alias("sole"))
    one = one.join(makers, "first", "left")
    return r.select("row_id", "source_key", "pid"), one


def _typo(a: Column, b: Column) -> Column:
    """One edit apart: insert, delete, replace, or two neighbours swapped."""
    near = F.levenshtein(a, b, 2)
    swapped = (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (F.least(F.length(a), F.length(b)) >= 5) & ((near == 1) | ((near == 2) & swapped))


def deletions(text: str) -> set[int]:
    """Hashes of a text and of all texts with one character less."""
    base, mod = 1_000_003, (1 << 61) - 1
    head, power = [0], [1]
    for c in text:
        head.append((head[-1] * base + ord(c)) % mod)
        power.append(power[-1] * base % mod)
    n, tail, out = len(text), 0, {head[-1]}
    for k in range(n - 1, -1, -1):  # tail: hash of what follows place k
        out.add((head[k] * power[n - 1 - k] + tail) % mod)
        tail = (ord(text[k]) * power[n - 1 - k] + tail) % mod
    return out


def name_typos(one: DataFrame) -> DataFrame:
    """(a, b): branded name forms one edit apart, a < b, by equal strings after deleting one character.

    The strings themselves are not made: their hashes are put together from those of beginnings
    and ends, so a name of any length costs its length.
    """
    s = one.where("branded and length(squash) >= 5").select("squash").distinct()

    @F.arrow_udf("array<bigint>")
    def cuts(names: pa.Array) -> pa.Array:
        return pa.array([sorted(deletions(x)) for x in names.to_pylist()], pa.list_(pa.int64()))

    v = s.select("squash", F.explode(cuts("squash")).alias("v"))
    pairs = v.select(F.col("squash").alias("a"), "v").join(v.select(F.col("squash").alias("b"), "v"), "v").where("a < b").select("a", "b").distinct()
    return pairs.where(_typo(F.col("a"), F.col("b")))


def candidate_pairs(one: DataFrame) -> DataFrame:
    """(a, b): pairs of profile ids, a < b, from blocks.

    In a block every profile meets the most seen profile of its own name and these meet the most
    seen one of the block: a number of pairs in proportion to the block, found by partial
    aggregation, whatever the block's size.
    """
    opt = lambda cond, tag, c: F.when(cond, F.concat(F.lit(tag), F.col(c)))
    keys = F.array_compact(
        F.array(
            opt(F.col("site").isNotNull(), "w:", "site"),
            opt(F.col("branded"), "q:", "squash"),
            opt(F.col("branded") & (F.size("words") > 1), "s:", "sorted"),
            opt(F.col("branded") & F.col("slug").isNotNull(), "q:", "slug"),
            opt(F.col("branded") & F.col("slug_sorted").contains(" "), "s:", "slug_sorted"),
            # Hard cases, mostly no matches: one maker's products, products of one everyday name.
            opt(F.col("branded") & (F.length("first") >= 5), "m:", "first"),
            opt(~F.col("branded") & (F.col("squash") != ""), "e:", "squash"),
        )
    )
    m = one.select("pid", "n", "squash", F.explode(F.array_distinct(keys)).alias("block"))
    top = lambda: F.max_by("pid", F.struct("n", "pid"))
    rep = m.groupBy("block", "squash").agg(top().alias("rep"), F.sum("n").alias("n"))
    hub = rep.groupBy("block").agg(F.max_by("rep", F.struct("n", "rep")).alias("hub"), F.count("*").alias("names"))
    inner = m.join(rep.select("block", "squash", "rep"), ["block", "squash"]).select(F.col("pid").alias("a"), F.col("rep").alias("b"))
    outer = rep.join(hub.where("names > 1"), "block").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    lead = one.groupBy("squash").agg(top().alias("rep"))
    t = name_typos(one)
    typo = t.join(lead.withColumnRenamed("squash", "a").withColumnRenamed("rep", "ra"), "a").join(lead.withColumnRenamed("squash", "b").withColumnRenamed("rep", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    pairs = inner.union(outer).union(typo).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def votes(pairs: DataFrame, one: DataFrame) -> DataFrame:
    """(a, b, *VOTERS): 1 for a match, -1 against, 0 where a function has nothing to say."""
    f = ["pid", "squash", "sorted", "words", "first", "branded", "site", "host", "slug", "slug_sorted", "tagline", "sole"]
    side = lambda s: one.select(F.col("pid").alias(s), *[F.col(x).alias(f"{s}_{x}") for x in f[1:]])
    j = pairs.join(side("a"), "a").join(side("b"), "b")
    A, B = (lambda x: F.col(f"a_{x}")), (lambda x: F.col(f"b_{x}"))
    same = (A("squash") == B("squash")) | (A("sorted") == B("sorted"))
    typo = _typo(A("squash"), B("squash")) | _typo(A("sorted"), B("sorted"))
    brands = A("branded") & B("branded")
    full = (F.size(A("words")) > 1) & (F.size(B("words")) > 1)
    part = ((F.size(A("words")) == 1) | (F.size(B("words")) == 1)) & (A("first") == B("first"))
    far = (F.levenshtein(A("squash"), B("squash"), 3) == -1) & (F.levenshtein(A("sorted"), B("sorted"), 3) == -1)
    # One maker, two products: the first word is the same, the rest is no misspelling of it.
    far = far | F.coalesce((A("first") == B("first")) & ~typo & ~same, F.lit(False))
    bare = lambda s, o: (F.size(s("words")) == 1) & s("site").isNull() & (F.size(o("words")) > 1)
    lone = brands & (A("first") == B("first")) & (bare(A, B) | bare(B, A))
    both = A("site").isNotNull() & B("site").isNotNull()
    vote = lambda yes, no=F.lit(False): F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0)
    told = lambda s, o: F.contains(F.regexp_replace(s("site"), "[^a-z0-9]", ""), o("squash")) & (F.length(o("squash")) >= 8) & (s("site").eqNullSafe(o("site")) | (F.size(o("words")) > 1))
    slug = (A("slug_sorted") == B("slug_sorted")) | (A("slug") == B("squash")) | (B("slug") == A("squash")) | (A("slug_sorted") == B("sorted")) | (B("slug_sorted") == A("sorted"))
    return j.select(
        "a",
        "b",
        # Makers keep several domains under a product's name; only sites that speak of something else contradict.
        vote(A("site") == B("site"), both & (A("site") != B("site")) & ~told(A, B) & ~told(B, A)).alias("site"),
        vote(brands & same, ~same & ~part & full & far).alias("name"),
        vote(brands & slug).alias("slug"),
        vote((same | typo) & (brands | F.coalesce(A("site") == B("site"), F.lit(False))), ~same & ~part & far).alias("spelling"),
        vote(told(A, B) | told(B, A), both & (A("host") != B("host")) & ~told(A, B) & ~told(B, A)).alias("host"),
        vote(A("tagline") == B("tagline")).alias("tagline"),
        # The maker's name alone, without a site, means its product if it has but one.
        vote(lone & F.coalesce(A("sole"), F.lit(False)), lone & ~F.coalesce(A("sole"), F.lit(False))).alias("maker"),
    )


class LabelModel:
    """Latent class (match or not) over votes, with a learned dependency tree between voters.

    P(votes, y) = P(y) prod P(v_k | v_parent(k), y) over the voters that vote; a voter that
    abstains says nothing. The tree is the maximum spanning tree of the conditional mutual
    information of voters given the class, so voters that repeat each other count little more
    than one. Tables and tree are learned together by expectation maximisation from the vote
    patterns and their counts, under a weak prior that a vote is right more often than wrong,
    which also fixes which class is the match.
    """

    PRIOR = 2.0

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60):
        self.n = patterns.shape[1]
        v = patterns.astype(int) + 1
        post = 1 / (1 + np.exp(-1.5 * patterns.sum(1)))  # the majority of the votes starts the search
        self.parent, self.order = [-1] * self.n, list(range(self.n))
        for k in range(rounds):
            if k % 10 == 5:
                self._tree(v, counts, post)
            self._fit(v, counts, post)
            post = self.posterior(patterns)

    def _tree(self, v: np.ndarray, counts: np.ndarray, post: np.ndarray) -> None:
        mi = np.zeros((self.n, self.n))
        for i in range(self.n):
            for j in range(i):
                both = (v[:, i] != 1) & (v[:, j] != 1)
                for w in (counts * post * both, counts * (1 - post) * both):
                    t = np.full((2, 2), 0.5)
                    np.add.at(t, (v[both, i] // 2, v[both, j] // 2), w[both])
                    t /= t.sum()
                    mi[i, j] += w.sum() / max(counts.sum(), 1e-9) * (t * np.log(t / (t.sum(1, keepdims=True) * t.sum(0, keepdims=True)))).sum()
        mi += mi.T
        self.parent, self.order = [-1] * self.n, [0]
        while len(self.order) < self.n:
            _, i, j = max((mi[i, j], -i, j) for i in range(self.n) if i not in self.order for j in self.order)
            self.parent[-i] = j
            self.order.append(-i)

    def _of_parent(self, v: np.ndarray, k: int) -> np.ndarray:
        return v[:, self.parent[k]] if self.parent[k] >= 0 else np.ones(len(v), int)

    def _fit(self, v: np.ndarray, counts: np.ndarray, post: np.ndarray) -> None:
        w = [counts * (1 - post), counts * post]
        self.prior = np.array([(x.sum() + 1) / (counts.sum() + 2) for x in w])
        self.tables = []
        for k in range(self.n):
            t = np.full((2, 3, 2), 0.5)
            t[0, :, 0] += self.PRIOR
            t[1, :, 1] += self.PRIOR
            told = v[:, k] != 1
            p = self._of_parent(v, k)[told]
            for y in (0, 1):
                np.add.at(t[y], (p, v[told, k] // 2), w[y][told])
            self.tables.append(t / t.sum(2, keepdims=True))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(match | votes) of each pattern."""
        v = patterns.astype(int) + 1
        log = np.tile(np.log(self.prior), (len(v), 1))
        for k in range(self.n):
            told = v[:, k] != 1
            p = self._of_parent(v, k)[told]
            for y in (0, 1):
                log[told, y] += np.log(self.tables[k][y][p, v[told, k] // 2])
        e = np.exp(log - log.max(1, keepdims=True))
        return e[:, 1] / e.sum(1)


def scored_pairs(one: DataFrame) -> DataFrame:
    """(a, b, confidence): candidate pairs of profiles with the label model's posterior."""
    v = cut(votes(candidate_pairs(one), one))
    table = bounded_rows(v.groupBy(*VOTERS).count().orderBy(*VOTERS), MAX_PATTERNS, "the vote patterns")
    if not table:
        return v.select("a", "b", F.lit(0.0).alias("confidence"))
    patterns = np.array([[r[k] for k in VOTERS] for r in table])
    model = LabelModel(patterns, np.array([float(r["count"]) for r in table]))
    spark = one.sparkSession
    known = [(*map(int, p), float(c)) for p, c in zip(patterns, model.posterior(patterns))]
    lookup = F.broadcast(spark.createDataFrame(known, ", ".join(f"{k} int" for k in VOTERS) + ", confidence double"))
    spoken = F.greatest(*VOTERS) == 1  # silence is no evidence
    return v.join(lookup, list(VOTERS)).select("a", "b", F.when(spoken, F.col("confidence")).otherwise(0.0).alias("confidence"))


def linked(rows: DataFrame, configs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sightings, profiles, scored pairs of profiles)."""
    seen, one = profiles(rows, configs)
    one = cut(one)
    return seen, one, cut(scored_pairs(one))


def scored(rows: DataFrame, configs: DataFrame) -> DataFrame:
    """(left_row_id, right_row_id, confidence): every compared pair of profiles with its posterior, each
    profile by the smallest row_id that shows it; ``products`` tells which rows belong to it."""
    seen, _, pairs = linked(rows, configs)
    lead = seen.groupBy("pid").agg(F.min("row_id").alias("row_id"))
    j = pairs.join(lead.select(F.col("pid").alias("a"), F.col("row_id").alias("x")), "a").join(lead.select(F.col("pid").alias("b"), F.col("row_id").alias("y")), "b")
    return j.select(F.least("x", "y").alias("left_row_id"), F.greatest("x", "y").alias("right_row_id"), "confidence")


def products(rows: DataFrame, configs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(row_id, source_key, product, confidence): every row that can be told apart, with its product's id.

    Profiles are one product when the model's posterior of a pair reaches ``threshold``, directly
    or through others; nothing outside the model links them. The confidence of a row is that of
    the best pair that holds its profile in the product, 1 for a profile that stands alone.
    """
    seen, one, pairs = linked(rows, configs)
    links = pairs.where(F.col("confidence") >= threshold)
    groups = connected_components(links, "a", "b")
    best = links.select(F.explode(F.array("a", "b")).alias("pid"), "confidence").groupBy("pid").agg(F.max("confidence").alias("confidence"))
    told = one.where("branded or site is not null").select("pid").join(groups, F.col("pid") == F.col("node"), "left").join(best, "pid", "left")
    told = told.select("pid", F.coalesce("component", "pid").alias("product"), F.coalesce("confidence", F.lit(1.0)).alias("confidence"))
    return seen.join(told, "pid").select("row_id", "source_key", "product", "confidence")


def row_pairs(rows: DataFrame, configs: DataFrame) -> DataFrame:
    """(left_row_id, right_row_id, confidence): pairs of rows of different sources that show one product.

    The confidence of a pair is the lower one of its rows. Products of many rows are paired part
    by part, each part under a key of its own, so no task holds a whole product. Null source keys
    count as one source of their own. Rows that repeat a row_id count once.
    """
    p = products(rows, configs).select("row_id", F.coalesce("source_key", F.lit("")).alias("source"), "product", "confidence")
    p = p.groupBy("row_id", "source", "product").agg(F.max("confidence").alias("confidence"))
    sizes = p.groupBy("product").agg(F.min("source").alias("x"), F.max("source").alias("y"), F.count("*").alias("size")).where("x <> y").select("product", F.ceil(F.col("size") / PART).alias("parts"))
    p = cut(p.join(sizes, "product"))
    left = p.select("product", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.col("row_id").alias("left_row_id"), F.col("source").alias("ls"), F.col("confidence").alias("lc"))
    right = p.select("product", F.pmod(F.xxhash64("row_id"), "parts").alias("part"), F.col("row_id").alias("right_row_id"), F.col("source").alias("rs"), F.col("confidence").alias("rc"))
    return left.join(right, ["product", "part"]).where("left_row_id < right_row_id and ls <> rs").select("left_row_id", "right_row_id", F.least("lc", "rc").alias("confidence"))
