"""Line-first cleaning: every line is judged by punctuation, navigation and boilerplate rules, failing lines go,
and a document that loses too much of its text, or fails the base rules, is rejected.

A line with words fails if
- punctuation: its symbols #*$%&|<> and ! number over a tenth of the characters in its words;
- navigation: at least 4 words of which a fifth or more are separators, or a third or more repeat the word before;
- boilerplate: it equals an earlier line of the text, or has at most 30 words and a phrase of PHRASES, in any language.
Lines without words are kept and count for nothing. A document is rejected if over LOST of its words are in
failing lines, or by the base rules of `judge`.

A null text has no words, is not kept and stays null; ids may be null or repeat, and there are no ties: each row is
judged alone. Very long texts are judged whole. Other
columns are ignored by `judge` and kept by `keep_good`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "»", "›", "·", "•", ">", "/", "::")
#: Phrases by language; together a RE2 pattern over the line with A-Z in lower case.
PHRASES = {
    "en": "all rights reserved|cookie policy|use of cookies|uses cookies|privacy policy|terms of use|terms of service|enable javascript|click here|sign up for|subscribe to our|powered by|lorem ipsum",
    "de": "alle rechte vorbehalten|verwendet cookies|verwenden cookies|datenschutzerklärung|nutzungsbedingungen|javascript aktivieren|klicken sie hier|newsletter abonnieren",
    "fr": "tous droits réservés|utilise des cookies|politique de confidentialité|conditions d.utilisation|activer javascript|cliquez ici|abonnez-vous",
    "es": "todos los derechos reservados|utiliza cookies|política de privacidad|términos de uso|activar javascript|haga clic aquí|suscríbase",
}
BOILERPLATE = "|".join(PHRASES.values())
#: Numerator and denominator of the share of words that may go.
LOST = (2, 5)
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_lines_removed long, n_words_lost long"


def per_group(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups, of which some may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def byte_counts(texts: pa.Array, which: str) -> np.ndarray:
    """How many bytes of each text are among these ASCII characters."""
    table = np.zeros(256, np.uint8)
    table[list(which.encode())] = 1
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    total = np.concatenate([[0], np.cumsum(table[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]], dtype=np.int64)]) if data is not None and len(texts) else np.zeros(1, np.int64)
    return np.diff(total[offsets - offsets[0]])


def assess(texts: pa.Array) -> tuple[dict, pa.Array, np.ndarray, np.ndarray]:
    """Counts of each text, its lines, how many lines each text has, and which lines fail."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, per = split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)
    flat, n = c.words(lines)
    owner = np.repeat(np.arange(len(per)), per)
    chars = per_group(pc.utf8_length(flat).to_numpy(zero_copy_only=False), n)
    symbols, bangs = byte_counts(lines, SYMBOLS), byte_counts(lines, "!")
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(len(n)), n)
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (line[1:] == line[:-1])
    marks = pc.is_in(flat, pa.array(SEPARATORS)).to_numpy(zero_copy_only=False)
    key = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((key, owner))
    repeat = np.zeros(len(key), bool)
    repeat[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    repeat &= n > 0
    phrase = np.zeros(len(n), bool)
    short = np.flatnonzero((n > 0) & (n <= 30))
    if len(short):
        phrase[short] = pc.match_substring_regex(pc.ascii_lower(lines.take(pa.array(short))), BOILERPLATE).to_numpy(zero_copy_only=False)
    fails = (n > 0) & ((10 * (symbols + bangs) > chars) | ((n >= 4) & ((5 * per_group(marks, n) >= n) | (3 * per_group(again, n) >= n))) | repeat | phrase)

    words = per_group(n, per)
    repeated = np.zeros(len(ids) + 1, np.int64)
    inside = c.starts_inside(words, 5)
    at = np.flatnonzero(inside)
    if len(at):
        doc = np.repeat(np.arange(len(words)), words)
        h = c.mixed(c.grams(c.mixed(ids.astype(np.uint64) + np.uint64(1)), 5)[at] + c.mixed(doc[at].astype(np.uint64)))
        order = np.argsort(h)
        s = c.group_starts(h[order])
        size = np.diff(np.append(s, len(h)))
        twice = at[order[np.repeat(size > 1, size)]]
        np.add.at(repeated, twice, 1)
        np.add.at(repeated, np.minimum(twice + 5, len(ids)), -1)
    covered = np.cumsum(repeated[:-1]) > 0
    out = {
        "n_words": words, "word_chars": per_group(chars, per), "n_symbols": per_group(symbols, per), "n_dup_lines": per_group(repeat, per),
        "n_repeat_words": per_group(covered, words), "n_lines": per_group(n > 0, per), "n_lines_removed": per_group(fails, per), "n_words_lost": per_group(n * fails, per),
    }
    out["base_failed"] = (words < 10) | (100 * out["n_repeat_words"] > 20 * words)
    out["kept"] = ~out["base_failed"] & (LOST[1] * out["n_words_lost"] <= LOST[0] * words)
    return out, lines, per, fails


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each row."""
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                got, *_ = assess(c.column(part, "text"))
                yield pa.RecordBatch.from_arrays([c.column(part, "doc_id"), *(pa.array(got[x]) for x in names[1:])], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, without their failing lines; n_chars, where there is one, is counted anew."""
    counted = "n_chars" in docs.columns

    def run(batches):
        for batch in batches:
            for part in c.slices(batch):
                got, lines, per, fails = assess(c.column(part, "text"))
                rows = np.flatnonzero(got["kept"])
                stay = ~fails & np.repeat(got["kept"], per)
                left = per_group(stay, per)[rows]
                offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
                text = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.filter(pa.array(stay))), "\n")
                out = part.take(pa.array(rows))
                out = out.set_column(out.schema.get_field_index("text"), out.schema.field("text"), text)
                if counted:
                    at = out.schema.get_field_index("n_chars")
                    out = out.set_column(at, out.schema.field(at), pc.utf8_length(text).cast(out.schema.field(at).type))
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return docs.mapInArrow(run, docs.schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(c.table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM d),
lw AS (SELECT r, line, k, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
lc AS (SELECT *, len(ws) AS n, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS chars,
  length(line) - length(translate(line, '{SYMBOLS}', '')) AS sym, length(line) - length(replace(line, '!', '')) AS bang,
  len(list_filter(ws, lambda x: list_contains({list(SEPARATORS)!r}, x))) AS marks,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS again,
  len(ws) > 0 AND row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS rep
  FROM lw),
lf AS (SELECT *, n > 0 AND (10 * (sym + bang) > chars OR (n >= 4 AND (5 * marks >= n OR 3 * again >= n)) OR rep
  OR (n <= 30 AND regexp_matches(translate(line, '{c.UPPER}', '{c.UPPER.lower()}'), '{BOILERPLATE}'))) AS fails FROM lc),
a AS (SELECT r, sum(n) AS n_words, sum(chars) AS word_chars, sum(sym) AS n_symbols, sum(rep::INT) AS n_dup_lines, sum((n > 0)::INT) AS n_lines,
  sum(fails::INT) AS n_lines_removed, sum(CASE WHEN fails THEN n ELSE 0 END) AS n_words_lost FROM lf GROUP BY r),
w AS (SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT r, p, array_to_string(ws[p:p+4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS p FROM w WHERE len(ws) >= 5)),
t AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rw AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM t) GROUP BY r),
o AS (SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_lines_removed AS BIGINT) AS n_lines_removed, CAST(n_words_lost AS BIGINT) AS n_words_lost
  FROM d JOIN a USING (r) LEFT JOIN rw USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {LOST[1]} * n_words_lost <= {LOST[0]} * n_words AS kept FROM o
"""
