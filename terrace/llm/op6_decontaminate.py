"""Benchmark decontamination by a distributed positional inverted index.

Each window of WINDOW benchmark words (a shorter item is one window) is looked up by its two rarest words. The number
of times that every benchmark word stands in the corpus is counted first; then the postings (word, document,
position) of the chosen words are stored as the index, the rarest word's list gives the places where a window may
start, and the second's list, moved by the distance between the two, is intersected with it. What is left is compared
word by word with the stored words of those documents, so matches are exact. The same index gives proximity matches:
documents where a window's two rarest words stand at most WINDOW words apart, in either order.

Native: DataFrame operations only. Spark broadcasts the benchmark's words, windows and spans within its size limit;
beyond it words are counted by task before they are shuffled, and postings are dealt out by word and salt.

Nulls: a null text has no words; a null doc_id is an id of its own. Rows with equal ids and texts get equal results.
Items are known by a hash of id and words, so texts that share an item_id, or have none, are items of their own in the
search; n_items counts distinct item_ids, all null ones as one, which the list leaves out. Very long texts are read
whole. Other columns are ignored. An empty table of documents gives an empty result; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

WINDOW = 13
#: Up to so many benchmark words are broadcast (some 10 MB); more are met by shuffle, under so many salts.
BROADCAST_TERMS, SALT = 200_000, 16
#: What separates words before A-Z are put in lower case.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KEY = ["id", "hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """id and hash name a row's content; null ids are set apart from others by a value that no hash join drops."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), F.xxhash64("doc_id", "text").alias("hash"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )


def places(docs: DataFrame) -> DataFrame:
    """A row for each word and its position. Positions count from the first split, so they are alike in every pass."""
    return docs.select(*KEY, F.posexplode(F.split("text", SEPARATOR)).alias("pos", "word")).select(*KEY, "pos", F.lower("word").alias("term"))


def item_words(benchmark: DataFrame) -> DataFrame:
    """key, item, iw: an item's words with A-Z in lower case, known by a hash of id and words. Items without words are left out."""
    words = F.array_remove(F.split(c.ascii_lower(F.col("text")), SEPARATOR), "")
    items = benchmark.select(F.col("item_id").alias("item"), words.alias("iw")).filter(F.size("iw") > 0)
    return items.select(F.xxhash64(F.col("item").isNull(), "item", "iw").alias("key"), "item", "iw").distinct()


def word_count(text) -> F.Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.array_remove(F.split(text, SEPARATOR), ""))).cast("long")


def counted(docs: DataFrame, vocabulary: DataFrame, small: bool) -> DataFrame:
    """(term, n): how often each word of the vocabulary stands in the corpus.

    A large vocabulary isn't sent to the words: they are counted by task, so a frequent one costs a row a task."""
    if small:
        return places(docs).join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    return places(docs).groupBy("term").agg(F.count("*").alias("n")).join(vocabulary, "term")


def postings(docs: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """The positional index over the given terms: (term, id, hash, pos). Many terms are met by word and salt."""
    if small:
        return places(docs).join(F.broadcast(terms), "term").select("term", *KEY, "pos")
    salted = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return places(docs).withColumn("salt", F.pmod(F.col("pos"), F.lit(SALT))).join(salted, ["term", "salt"]).select("term", *KEY, "pos")


def near(first: DataFrame, second: DataFrame, on: list[str], within: int) -> DataFrame:
    """Pairs of rows of first (p) and second (q) that are equal in `on` and at most `within` positions apart.

    Positions are put in strips of `within`, so a join on neighbouring strips replaces one on all pairs of a document."""
    strip = lambda x, d: F.floor(F.col(x) / max(1, within)) + d
    a = first.withColumn("strip", F.explode(F.array(*(strip("p", d) for d in (-1, 0, 1)))))
    pairs = a.join(second.withColumn("strip", strip("q", 0)), [*on, "strip"]).drop("strip")
    return pairs.filter((F.abs(F.col("p") - F.col("q")) <= within) & (F.col("p") != F.col("q")))


def proximity(docs: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """doc_id of each document that has both words at most `within` positions apart, in either order."""
    spark, keys = docs.sparkSession, keyed(docs)
    terms = spark.createDataFrame([(x.lower(),) for x in {first, second}], "term string")
    found = postings(keys, terms, True)
    a, b = (found.filter(F.col("term") == x.lower()).select(*KEY, F.col("pos").alias(p)) for x, p in ((first, "p"), (second, "q")))
    return keys.join(near(a, b, KEY, within).select(*KEY), KEY, "left_semi").select("doc_id")


class Search:
    """Benchmark windows looked up in a corpus. `docs` is keyed; the tables are staged in the shared folder."""

    def __init__(self, spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW):
        self.scratch, self.docs, self.window = c.Scratch(spark, "decontaminate"), docs, window
        self.items = self.scratch.put(item_words(benchmark), "items")
        words = self.scratch.put(self.items.select(F.explode("iw").alias("word")).select(F.lower("word").alias("term")).distinct(), "vocabulary")
        self.small = words.count() <= BROADCAST_TERMS
        counts = self.scratch.put(counted(docs, words, self.small), "counts")
        self.anchors = self.scratch.put(self._anchors(counts), "anchors")
        terms = self.anchors.select(F.explode(F.array("t1", "t2")).alias("term")).filter("term is not null").distinct()
        self.index = self.scratch.put(postings(docs, terms, self.small), "index")

    def _anchors(self, counts: DataFrame) -> DataFrame:
        """The two rarest words of each window and their places in the item; a word that the corpus lacks drops the window."""
        size = F.least(F.size("iw"), F.lit(self.window))
        spans = (
            self.items.select("key", size.alias("len"), "iw")
            .select("key", "len", "iw", F.explode(F.sequence(F.lit(0), F.size("iw") - F.col("len"))).alias("w"))
        )
        at = spans.select("key", "w", "len", F.posexplode(F.slice("iw", F.col("w") + 1, F.col("len"))).alias("o", "word"))
        known = at.select("key", "w", "len", (F.col("w") + F.col("o")).alias("q"), F.lower("word").alias("term")).join(counts, "term")
        by = Window.partitionBy("key", "w")
        ranked = known.withColumn("r", F.row_number().over(by.orderBy("n", "term", "q"))).withColumn("found", F.count("*").over(by))
        pick = lambda r, x: F.max(F.when(F.col("r") == r, F.col(x)))
        two = (
            ranked.filter("found = len and r <= 2")
            .groupBy("key", "w")
            .agg(pick(1, "term").alias("t1"), pick(1, "q").alias("q1"), pick(2, "term").alias("t2"), pick(2, "q").alias("q2"))
        )
        return two.select("key", "t1", "q1", "t2", "q2").distinct()

    def phrases(self) -> DataFrame:
        """(id, hash, key, start, end): spans of document positions that windows of items cover."""
        first = self.index.withColumnsRenamed({"term": "t1", "pos": "p1"}).join(self.anchors, "t1").withColumn("shift", F.col("p1") - F.col("q1"))
        second = self.index.withColumnsRenamed({"term": "t2", "pos": "p2"})
        both = first.withColumn("p2", F.col("shift") + F.col("q2")).join(second, ["t2", *KEY, "p2"], "left_semi")
        both = both.unionByName(first.filter("t2 is null"), allowMissingColumns=True)
        found = self.scratch.put(both.select(*KEY, "key", "shift").distinct(), "found")

        # exact comparison with the words of those documents alone
        texts = self.docs.join(found.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, F.split("text", SEPARATOR).alias("dw"))
        texts = self.scratch.put(texts.dropDuplicates(KEY), "texts")
        n, size = F.size("iw"), F.least(F.size("iw"), F.lit(self.window))
        same = F.transform("iw", lambda x, i: F.coalesce(c.ascii_lower(F.get("dw", F.col("shift") + i)) == x, F.lit(False)))
        part = found.join(self.items, "key").join(texts, KEY).select(*KEY, "key", "shift", n.alias("n"), size.alias("len"), same.alias("same"))
        starts = F.filter(F.sequence(F.lit(0), F.col("n") - F.col("len")), lambda i: F.forall(F.slice("same", i + 1, F.col("len")), lambda x: x))
        start = F.col("shift") + F.col("w")
        return (
            part.select(*KEY, "key", "shift", "len", F.explode(starts).alias("w"))
            .select(*KEY, "key", start.alias("start"), (start + F.col("len")).alias("end"))
        )

    def neighbours(self) -> DataFrame:
        """(id, hash, key): documents where the two rarest words of one of the item's windows stand within the window's length."""
        first = self.index.withColumnsRenamed({"term": "t1", "pos": "p"}).join(self.anchors.select("key", "t1", "t2").distinct(), "t1")
        second = self.index.withColumnsRenamed({"term": "t2", "pos": "q"})
        return near(first, second, ["t2", *KEY], self.window).select(*KEY, "key").distinct()


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, id, hash, n_words, n_hit, n_items, items_sha256, contaminated of each row."""
    docs = keyed(docs)
    search = Search(spark, docs, benchmark, window)
    spans = search.scratch.put(search.phrases().distinct(), "spans")
    search.scratch.drop("index", "texts", "found")
    # words covered: each span adds what lies beyond the spans that start before it
    by = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = spans.select(*KEY, "start", "end").distinct().withColumn("reach", F.coalesce(F.max("end").over(by), F.lit(0)))
    hit = fresh.groupBy(*KEY).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))).cast("long").alias("n_hit"))
    items = (
        spans.select(*KEY, "key")
        .distinct()
        .join(search.items.select("key", F.col("item").cast("string").alias("item")), "key")
        .select(*KEY, "item")
        .distinct()
    )
    items = items.groupBy(*KEY).agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("list"))
    out = docs.select("doc_id", *KEY, word_count(F.col("text")).alias("n_words")).join(hit.join(items, KEY), KEY, "left")
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("long").alias(x)
    out = out.select("doc_id", *KEY, "n_words", zero("n_hit"), zero("n_items"), F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that aren't contaminated, columns as they were. The list of the others is stored first, so that its size
    is known when Spark chooses between broadcasting it and shuffling texts."""
    bad = contamination(spark, docs, benchmark).filter("contaminated").select(F.col("id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    bad = c.Scratch(spark, "contaminated").put(bad, "bad")
    return docs.join(
        bad,
        (F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63))) == bad["_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == bad["_hash"]),
        "left_anti",
    )


def near_items(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, item_id, distinct: proximity matches, which include the exact ones but for windows of a single word."""
    docs = keyed(docs)
    search = Search(spark, docs, benchmark, window)
    found = search.scratch.put(search.neighbours(), "near").join(search.items.select("key", F.col("item").alias("item_id")), "key")
    return docs.select("doc_id", *KEY).join(found, KEY).select("doc_id", "item_id").distinct()


def op6b_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_items(spark, c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "benchmark"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, c.table(spark, sf_dir, "documents"), c.table(spark, sf_dir, "benchmark")).drop(*KEY)


SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{c.UPPER}', '{c.UPPER.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{c.UPPER}', '{c.UPPER.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS n, array_to_string(ws[w:w + least(len(ws), {WINDOW}) - 1], ' ') AS g FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS w FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d JOIN sizes ON len(ws) >= n)),
m AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id),
o AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256
  FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id)
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM o
"""

PROXIMITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '{SEPARATOR}'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{c.UPPER}', '{c.UPPER.lower()}'), '{SEPARATOR}'), lambda x: x <> '') AS iw FROM benchmark),
k AS (SELECT row_number() OVER () AS key, item_id, iw, least(len(iw), {WINDOW}) AS n FROM b WHERE len(iw) > 0),
w AS (SELECT key, iw, n, unnest(range(len(iw) - n + 1)) AS w FROM k),
o AS (SELECT key, w, n, iw, unnest(range(w, w + n)) AS q FROM w),
t AS (SELECT key, w, n, q, lower(iw[q + 1]) AS term FROM o),
p AS (SELECT r, lower(x) AS term, p FROM (SELECT r, unnest(ws) AS x, unnest(range(len(ws))) AS p FROM d) WHERE lower(x) IN (SELECT term FROM t)),
c AS (SELECT term, count(*) AS c FROM p GROUP BY term),
rk AS (SELECT t.*, row_number() OVER (PARTITION BY key, w ORDER BY c, term, q) AS rn, count(*) OVER (PARTITION BY key, w) AS found FROM t JOIN c USING (term)),
a AS (SELECT DISTINCT key, t1, t2 FROM (SELECT key, w, max(term) FILTER (rn = 1) AS t1, max(term) FILTER (rn = 2) AS t2 FROM rk WHERE found = n GROUP BY key, w)),
m AS (SELECT DISTINCT x.r, key FROM a JOIN p x ON x.term = t1 JOIN p y ON y.term = t2 AND y.r = x.r AND abs(x.p - y.p) <= {WINDOW} AND x.p <> y.p)
SELECT DISTINCT doc_id, item_id FROM m JOIN d USING (r) JOIN k USING (key)
"""
