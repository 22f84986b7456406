r"""Line-first cleaning of documents, with DataFrame functions only.

Every line is judged by itself; failing lines go, and a document that
loses too much of its text is rejected.  A line fails when it

* repeats an earlier line of the document (boilerplate),
* is a short line with a site phrase (boilerplate: ``PHRASES``),
* has three or more separators ``|``, ``»``, ``•`` or ``·`` between words
  (navigation),
* has a share of symbols of ``SYMBOL_SHARE`` or more, ends more than a fifth
  of its words with ``!!``, or is written in capitals over at least
  ``CAPITAL_WORDS`` words (punctuation and shouting),
* holds no letter or digit at all, or has under ``SHORT_LINE`` words without
  a sentence end in a document of several lines (punctuation).

Null text counts as empty.  Empty texts have no words, fail the base rule and
are rejected.  Rows are judged one by one, so repeated rows, null ids, null
other columns and an empty table need no special case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import table, words_sql

# Phrases of site furniture, matched in lower case.
PHRASES = [
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy",
    "enable javascript", "log in", "lorem ipsum", "next page", "privacy policy", "read more",
    "sign in", "sign up", "skip to content", "subscribe to", "terms of use",
]
SYMBOLS = "#*$%&|<>"
SYMBOL_SHARE = 0.1
SHORT_LINE = 3
PHRASE_WORDS = 12
CAPITAL_WORDS = 4
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A document goes when under this share of its words stays.
MIN_KEPT_SHARE = 0.5


def _only(text: str, kinds: str) -> str:
    """Number of characters of a class: the runs of all others are cut out."""
    return f"length(regexp_replace({text}, '[^{kinds}]+', ''))"


def _line_fails(line: str, n: str, lines: str) -> str:
    """Whether a line of ``n`` words fails; rules that need no look at the
    whole line decide first which lines the others are asked for."""
    phrases = "|".join(PHRASES)
    solid = f"length(replace(replace(replace({line}, ' ', ''), '\\t', ''), '\\r', ''))"
    rules = [
        f"{_only(line, '|»•·')} >= 3",
        f"{_only(line, SYMBOLS)} >= {SYMBOL_SHARE}D * {solid}",
        f"(length({line}) - length(replace({line}, '!!', ''))) / 2 > greatest(1, 0.2D * {n})",
        f"{n} >= {CAPITAL_WORDS} and not {line} rlike '[a-z]' and upper({line}) = {line} and lower({line}) <> {line}",
        f"not {line} rlike '[\\\\p{{L}}\\\\p{{N}}]'",
        f"{n} < {SHORT_LINE} and size({lines}) > 1 and not {line} rlike '[.!?…:;。！？][\"\\')»”]*\\\\s*$'",
        f"{n} <= {PHRASE_WORDS} and lower({line}) rlike '{phrases}'",
    ]
    return " or ".join(f"({r})" for r in rules)


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``clean_text`` (its lines that pass, in
    order), ``n_lines`` (lines with a word), ``n_dup_lines`` and
    ``n_clean_words``.  Columns of these names in ``docs`` are replaced."""
    out = docs.withColumn("_lines", F.expr(
        f"filter(split(coalesce(`{text}`, ''), '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    out = out.withColumn("_distinct", F.array_distinct("_lines"))
    # a line's words are counted once, for the rules and for the sum
    out = out.withColumn("_kept", F.expr(f"""filter(
        transform(_distinct, l -> named_struct('l', l, 'n', regexp_count(l, '[^\\\\x20\\\\x09-\\\\x0D]+'))),
        s -> not ({_line_fails('s.l', 's.n', '_lines')}))"""))
    return out.withColumns({
        "clean_text": F.expr("array_join(transform(_kept, s -> s.l), '\\n')"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size("_distinct")).cast("long"),
        "n_clean_words": F.expr("aggregate(_kept, 0L, (a, s) -> a + s.n)"),
    }).drop("_lines", "_distinct", "_kept")


def repeated_words(docs: DataFrame, hashes: str, out: str, window: int = 8) -> DataFrame:
    """Adds ``out``: how many words lie in windows of eight words that the
    text has twice or more.  ``hashes`` is the array of its words' hashes.

    Window hashes come from three doubling steps; a text whose windows all
    differ, the usual case, is done after one distinct count.
    """
    if window != 8:
        raise ValueError("windows are built by doubling three times: eight words")
    df = docs.withColumn("_h", F.col(hashes))
    for step in (1, 2, 4):
        df = df.withColumn("_h", F.expr(f"zip_with(_h, slice(_h, {step + 1}, greatest(size(_h) - {step}, 0)), (a, b) -> xxhash64(a, b))"))
    df = df.withColumn("_h", F.expr("slice(_h, 1, greatest(size(_h) - 7, 0))"))
    df = df.withColumn("_at", F.expr(
        "case when size(array_distinct(_h)) < size(_h) then sort_array(transform(_h, (h, i) -> struct(h as h, i as i))) end"))
    df = df.withColumn("_at", F.expr(
        "sort_array(filter(transform(_at, (x, k) -> case when (k > 0 and get(_at, k - 1).h = x.h)"
        " or (k < size(_at) - 1 and get(_at, k + 1).h = x.h) then x.i end), i -> i is not null))"))
    covered = "aggregate(zip_with(_at, slice(_at, 2, size(_at)), (a, b) -> coalesce(least(8, b - a), 8)), 0, (s, x) -> s + x)"
    return df.withColumn(out, F.expr(f"coalesce({covered}, 0)").cast("long")).drop("_h", "_at")


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the cleaned text, the base counts and both verdicts."""
    t = f"coalesce(`{text}`, '')"
    out = docs.withColumn("_hashes", F.expr(f"transform({words_sql(t)}, w -> xxhash64(w))"))
    out = out.withColumns({
        "n_words": F.size("_hashes").cast("long"),
        "word_chars": F.expr(f"length(regexp_replace({t}, '[\\\\x20\\\\x09-\\\\x0D]+', ''))").cast("long"),
        "n_symbols": F.expr(_only(t, SYMBOLS)).cast("long"),
    })
    out = repeated_words(out, "_hashes", "n_repeat_words").drop("_hashes")
    out = clean_lines(out, text)
    out = out.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    return out.withColumn("kept", F.expr(f"not base_failed and n_clean_words >= {MIN_KEPT_SHARE}D * n_words"))


def op4_line_cleaning(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_clean_words")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, hash(text) AS t, i, hash(array_to_string(list_slice(words, i, i + 7), ' ')) AS q
  FROM (SELECT doc_id, text, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
h AS (
  SELECT doc_id, t, i FROM g SEMI JOIN (SELECT doc_id, t, q FROM g GROUP BY ALL HAVING count(*) > 1) m USING (doc_id, t, q)),
r AS (
  SELECT doc_id, t, i, lead(i) OVER (PARTITION BY doc_id, t ORDER BY i) AS nxt FROM h),
c AS (
  SELECT doc_id, t, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n FROM r GROUP BY ALL),
l AS (
  SELECT doc_id, text, words, lines, list_distinct(lines) AS uniq FROM w),
k AS (
  SELECT doc_id, text, words, lines, uniq, list_filter(uniq, lambda s: NOT (
      length(s) - length(translate(s, '|»•·', '')) >= 3
   OR length(regexp_replace(s, '[ \t\r]', '', 'g')) - length(translate(regexp_replace(s, '[ \t\r]', '', 'g'), '#*$%&|<>', ''))
        >= 0.1::DOUBLE * length(regexp_replace(s, '[ \t\r]', '', 'g'))
   OR (length(s) - length(replace(s, '!!', ''))) / 2 > greatest(1, 0.2::DOUBLE * len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')))
   OR (upper(s) = s AND lower(s) <> s AND len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) >= 4)
   OR NOT regexp_matches(s, '[\p{L}\p{N}]')
   OR (len(lines) > 1 AND NOT regexp_matches(s, '[.!?…:;。！？]["'')»”]*\s*$') AND len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) < 3)
   OR (regexp_matches(lower(s), 'PHRASES') AND len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) <= 12))) AS good
  FROM l),
o AS (
  SELECT k.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(coalesce(k.text, ''), '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(coalesce(k.text, '')) - length(translate(coalesce(k.text, ''), '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(uniq))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, list_sum(list_transform(good, lambda s: len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')))) AS clean
  FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND hash(k.text) = c.t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, coalesce(clean, 0)::BIGINT AS n_clean_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(clean, 0) >= 0.5::DOUBLE * n_words AS kept
FROM o
""".replace("PHRASES", "|".join(PHRASES))
