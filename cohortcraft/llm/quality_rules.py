"""Quality rules: one projection of length, symbol, stop-word and line ratios.

``quality_rules(docs)`` adds the measures, the base rule and the verdict to
every row, with built-in functions only (no UDF, no shuffle, one pass).

Defined cases: a null or empty text has no words, so every count is 0, the
base rule fails and the row is not kept. Rows are judged alone, so repeated
rows get the same verdict; columns of the input that carry a measure's name
are replaced. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "der die und den von zu das mit sich des auf für ist im dem eine ein nicht als "
    "de la le et les en un du une que pour est dans qui par au pas sur avec "
    "el y los se las del por con no para su al lo es una"
).split()

SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = " \t\n\x0b\f\r"
_SPLIT = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """Keep rows whose ``measure`` lies within [low, high] (None: open)."""

    measure: str
    low: float | None
    high: float | None


# The threshold table. Ratios are per word, except dup_line_ratio (per line with a word).
RULES = (
    Rule("n_words", 50, None),
    Rule("repeat_ratio", None, 0.5),
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("shout_ratio", None, 0.1),
    Rule("stop_ratio", 0.08, None),
    Rule("dup_line_ratio", None, 0.5),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _stop_list() -> list[str]:
    return [form for w in dict.fromkeys(STOP_WORDS) for form in (w, w.capitalize())]


def _i(x: Column) -> Column:
    return x.cast("int")


def _once(x: Column) -> Column:
    """``x``, computed where it stands.

    The condition always holds; being non-deterministic it keeps the optimiser
    from copying ``x`` into every later use, such as a filter on the verdict.
    """
    return F.when(F.monotonically_increasing_id() >= 0, x)


def _with_words(docs: DataFrame, text: str) -> DataFrame:
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SEPARATORS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPLIT))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.withColumns({"_w": words, "_lines": lines})


# Window positions are packed under 40 hash bits while they fit 23 bits; a
# longer text sorts (hash, position) pairs instead. Hash groups are only
# candidates: the windows themselves decide.
_POSITIONS = 1 << 23


def _candidates(df: DataFrame) -> DataFrame:
    """_pos: start positions of windows whose hash occurs twice or more in the text."""
    n = F.size("_w")
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    w = F.col("_w")
    window_hash = lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
    packed = F.sort_array(
        F.transform(at, lambda i: F.shiftleft(window_hash(i).bitwiseAND(F.lit((1 << 40) - 1)), 23).bitwiseOR(i.cast("long")))
    )
    pairs = F.sort_array(F.transform(at, lambda i: F.struct(window_hash(i).alias("h"), i.alias("i"))))
    df = df.withColumns(
        {
            "_packed": _once(F.when(n <= _POSITIONS, packed).otherwise(F.array().cast("array<bigint>"))),
            "_pairs": _once(F.when(n > _POSITIONS, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))),
        }
    )
    p, q = F.col("_packed"), F.col("_pairs")
    last_p, last_q = F.size(p) - 1, F.size(q) - 1
    hash_of = lambda x: F.shiftrightunsigned(x, 23)
    in_packed = F.filter(
        p,
        lambda x, k: ((k > 0) & (hash_of(F.get(p, k - 1)) == hash_of(x))) | ((k < last_p) & (hash_of(F.get(p, k + 1)) == hash_of(x))),
    )
    in_pairs = F.filter(
        q,
        lambda x, k: ((k > 0) & (F.get(q, k - 1)["h"] == x["h"])) | ((k < last_q) & (F.get(q, k + 1)["h"] == x["h"])),
    )
    positions = F.concat(
        F.transform(in_packed, lambda x: _i(x.bitwiseAND(F.lit(_POSITIONS - 1)))),
        F.transform(in_pairs, lambda x: x["i"]),
    )
    return df.withColumn("_pos", _once(positions))


def _repeated(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside windows that truly occur twice or more."""
    w = F.col("_w")
    grams = F.sort_array(
        F.transform(F.col("_pos"), lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("g"), i.alias("i")))
    )
    df = df.withColumn("_grams", _once(grams))
    g, last = F.col("_grams"), F.size("_grams") - 1
    twice = F.filter(
        g,
        lambda x, k: ((k > 0) & (F.get(g, k - 1)["g"] == x["g"])) | ((k < last) & (F.get(g, k + 1)["g"] == x["g"])),
    )
    df = df.withColumn("_twice", _once(F.sort_array(F.transform(twice, lambda x: x["i"]))))
    t, end = F.col("_twice"), F.size("_twice") - 1
    covered = F.transform(t, lambda x, k: F.when(k == end, F.lit(3)).otherwise(F.least(F.lit(3), F.get(t, k + 1) - x)))
    return df.withColumn("n_repeat_words", _once(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (F.col(r.measure) >= F.lit(r.low))
        if r.high is not None:
            out = out & (F.col(r.measure) <= F.lit(r.high))
    return out


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add measures, ratios, ``base_failed`` and ``kept`` to every row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = _with_words(docs, text)
    df = _repeated(_candidates(df))
    stop = _stop_list()
    n = F.size("_w").cast("long")
    per_word = lambda x: x / F.greatest(F.size("_w"), F.lit(1))
    df = df.withColumns(
        {
            "n_words": _once(n),
            "word_chars": _once(F.char_length(F.array_join("_w", "")).cast("long")),
            "n_symbols": _once(F.regexp_count(body, F.lit(SYMBOLS)).cast("long")),
            "n_dup_lines": _once((F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")),
            "_n_lines": F.size("_lines").cast("long"),
            "n_stop_words": _once(F.size(F.filter("_w", lambda x: x.isin(stop))).cast("long")),
            "_n_shouts": F.regexp_count(body, F.lit("!")).cast("long"),
        }
    )
    df = df.withColumns(
        {
            "mean_word_chars": per_word(F.col("word_chars")),
            "symbol_ratio": per_word(F.col("n_symbols")),
            "shout_ratio": per_word(F.col("_n_shouts")),
            "stop_ratio": per_word(F.col("n_stop_words")),
            "repeat_ratio": per_word(F.col("n_repeat_words")),
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    df = df.withColumn("kept", ~F.col("base_failed") & verdict(rules))
    hidden = [c for c in df.columns if c.startswith("_") and c not in docs.columns]
    return df.drop(*hidden)


def without_rejected(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns as they were."""
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    return quality_rules(whole, "_text", rules).where("kept").select("_row.*")
