"""Operator 4: quality rules as one Spark projection, without user functions.

``RULES`` is a threshold table: a measure, its least and its greatest value.
``measures`` adds the counts (words, characters in words, symbols, repeated
lines, words in repeated three-word windows, stop words, ...) and ``judge``
compiles the table to one boolean column.

Windows are compared by the upper 40 bits of a hash with the position in the
lower 24 bits, so that one array of longs is sorted; neighbours of equal hash
are then compared by their words.  Where two different windows share the 40
bits, or a text has more words than 24 bits count, a slower sort of the words
themselves takes over, so the counts are exact.

Edge cases: NULL counts as empty text (no words: the base test fails); texts
of fewer than three words have no windows; repeated rows are judged each; an
empty table gives an empty table; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was with be on are as by this from "
    "der die und den das von zu mit nicht ein eine ist auf für des dem sich "
    "le la les de et des un une du que est dans pour en par sur au "
    "el los las que y del se por con una su para al lo como más"
).split()
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
POSITION_BITS = 24


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose measure is below ``least`` or above ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Production thresholds: length, symbol, stop-word and line ratios.
RULES = (
    Rule("word_length", "word_chars / greatest(n_words, 1)", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", None, 0.25),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", None, 0.5),
)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines", "n_stop_words")


def _covered(places: Column) -> Column:
    """Words in the windows that begin at these places."""
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))


def _repeat_words() -> tuple[Column, Column]:
    """Words in windows of three that occur more than once, from ``_words`` and ``_windows``."""
    w, s = F.col("_words"), F.col("_windows")
    place = lambda k: F.get(s, k).bitwiseAND((1 << POSITION_BITS) - 1).cast("int")
    window = lambda p: F.struct(F.get(w, p), F.get(w, p + 1), F.get(w, p + 2))
    equal = lambda k: F.shiftright(F.get(s, k), POSITION_BITS) == F.shiftright(F.get(s, k - 1), POSITION_BITS)
    after = F.when(F.size(s) > 1, F.filter(F.sequence(F.lit(1), F.size(s) - 1), equal)).otherwise(F.array().cast("array<int>"))
    collide = F.exists(F.col("_after"), lambda k: window(place(k)) != window(place(k - 1)))
    quick = _covered(F.concat(F.transform(F.col("_after"), place), F.transform(F.col("_after"), lambda k: place(k - 1))))
    return after, F.when(F.size("_after") == 0, 0).when(collide, _slow_repeat()).otherwise(quick)


def _slow_repeat() -> Column:
    """The same from a sort of the words themselves."""
    w = F.col("_words")
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))
    ordered = F.array_sort(windows)
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    kept = F.filter(ordered, lambda x, k: F.coalesce(same(x, F.get(ordered, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(ordered, k + 1)), F.lit(False)))
    return _covered(F.transform(kept, lambda x: x["i"]))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules compare."""
    taken = {"_text", "_words", "_lines", "_windows", "_after", *_COUNTS} & set(docs.columns)
    if taken - {text_col}:
        raise ValueError(f"columns already there: {sorted(taken)}")
    w = F.col("_words")
    packed = lambda i: F.shiftleft(F.shiftright(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), POSITION_BITS), POSITION_BITS).bitwiseOR(i.cast("bigint"))
    none = F.array().cast("array<bigint>")
    long = F.size(w) >= 1 << POSITION_BITS
    windows = F.when((F.size(w) < 3) | long, none).otherwise(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), packed)))
    after, repeated = _repeat_words()
    text = F.col("_text")
    out = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    out = out.withColumns({
        "_words": F.array_remove(F.split(text, GAP), ""),
        "_lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
    }).withColumn("_windows", windows).withColumn("_after", after)
    lines = F.col("_lines")
    count = lambda c: c.cast("bigint")
    return out.withColumns({
        "n_words": count(F.size(w)),
        "word_chars": count(F.length(F.array_join(w, ""))),
        "n_symbols": count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_dup_lines": count(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_repeat_words": count(F.when(long, _slow_repeat()).otherwise(repeated)),
        "n_lines": count(F.size(lines)),
        "n_bullet_lines": count(F.size(F.filter(lines, lambda x: x.rlike("^[\\x20\\x09-\\x0D]*([-*•]|[0-9]+[.)])[\\x20\\x09]")))),
        "n_ellipsis_lines": count(F.size(F.filter(lines, lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$")))),
        "n_stop_words": count(F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in dict.fromkeys(STOP_WORDS)])))),
    }).drop("_text", "_words", "_lines", "_windows", "_after")


def judge(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(base_failed, kept) over the counts."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = ~failed
    for rule in rules:
        value = F.expr(rule.measure)
        if rule.least is not None:
            kept = kept & (value >= F.lit(rule.least))
        if rule.most is not None:
            kept = kept & (value <= F.lit(rule.most))
    return failed, F.coalesce(kept, F.lit(False))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    failed, kept = judge(rules)
    return measures(docs, text_col).withColumns({"base_failed": failed, "kept": kept})


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the same rows over ``documents``."""
    stops = ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))
    tests = [f"{r.measure} >= {r.least}" for r in rules if r.least is not None] + [f"{r.measure} <= {r.most}" for r in rules if r.most is not None]
    symbols = "[#*$%&|<>]"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
    a AS (SELECT k, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
    g AS (SELECT k, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'x': w[i], 'y': w[i + 1], 'z': w[i + 2]}})) AS s FROM a WHERE len(w) > 2),
    r AS (SELECT k, s.i AS i, count(*) OVER (PARTITION BY k, s.x, s.y, s.z) AS n FROM g),
    c AS (SELECT k, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) AS v(o) WHERE r.n > 1 GROUP BY k),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '{symbols}'))::BIGINT AS n_symbols,
                 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
                 len(l)::BIGINT AS n_lines,
                 len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*([-*•]|[0-9]+[.)])[\\x20\\x09]')))::BIGINT AS n_bullet_lines,
                 len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')))::BIGINT AS n_ellipsis_lines,
                 len(list_intersect(w, [{stops}]))::BIGINT AS n_stop_words
          FROM a LEFT JOIN c USING (k)),
    b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {" AND ".join(f"({t})" for t in tests)} AS kept FROM b"""
