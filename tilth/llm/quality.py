"""Quality rules: a threshold table compiled into one projection, without user functions.

``Rule`` rows compare ``scale * numerator`` with ``bound * denominator`` in whole
numbers, so every engine reaches the same verdict.  The signals are length, symbol,
stop-word and line counts of the whole text.

``few_stop_words`` knows the words of four languages (English, German, French, Spanish) and
rejects running text in any other: pass ``rules`` without it for such documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import ASCII_SPACE, ascii_lower, let, words

# Frequent function words of the four languages, as plain text.
STOP_WORDS = sorted(set((
    "the be to of and that have with in is it for on as are this by from at or an a was "
    "der die das und ist nicht ein eine den von zu mit sich auf für dem des im in "
    "le la les de des et est un une dans que pour qui sur au du en il avec pas "
    "el los las que y del un una por con para se su es no lo al como"
).split()))

SYMBOLS = r"[#*$%&|<>]"
SHOUTS = r"[!?]"
BULLETS = ("-", "*", "•", "·", "–")


@dataclass(frozen=True)
class Rule:
    """Reject when ``scale * numerator OP bound * denominator`` (denominator 1 if none)."""
    name: str
    numerator: str
    op: str
    bound: int
    denominator: str | None = None
    scale: int = 100

    def sql(self) -> str:
        if self.denominator:
            return f"{self.scale} * {self.numerator} {self.op} {self.bound} * {self.denominator}"
        return f"{self.numerator} {self.op} {self.bound}"

    def rejects(self, signals: Column) -> Column:
        left, right = signals[self.numerator], F.lit(self.bound)
        if self.denominator:
            left, right = left * self.scale, signals[self.denominator] * self.bound
        return left < right if self.op == "<" else left > right


# The base rules of the contract.
BASE_RULES = (
    Rule("too_short", "n_words", "<", 50),
    Rule("repeats_itself", "n_repeat_words", ">", 50, "n_words"),
)

# Production thresholds, in percent of the denominator.
RULES = (
    Rule("too_long", "n_words", ">", 1_000_000),
    Rule("short_words", "word_chars", "<", 200, "n_words"),
    Rule("long_words", "word_chars", ">", 2000, "n_words"),
    Rule("symbols", "n_symbols", ">", 10, "n_words"),
    Rule("shouting", "n_shouts", ">", 50, "n_words"),
    Rule("few_stop_words", "n_stop_words", "<", 2, "n_words"),
    Rule("duplicate_lines", "n_dup_lines", ">", 50, "n_lines"),
    Rule("bullet_lines", "n_bullet_lines", ">", 90, "n_lines"),
    Rule("ellipsis_lines", "n_ellipsis_lines", ">", 30, "n_lines"),
)

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_shouts", "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text.

    The windows of one text are sorted by a 64-bit hash with their place, so equal ones
    stand side by side: n log n for a text of any length, and no map that is searched
    from its start."""
    def marked(s: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            twin = (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            return F.when(F.coalesce(twin, F.lit(False)), x["i"])
        return F.array_compact(F.transform(s, place))

    def covered(p: Column) -> Column:
        return F.size(F.array_distinct(F.concat(
            p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2))))

    def of(x: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(x) - 3), lambda i: F.struct(
            F.xxhash64(F.get(x, i), F.get(x, i + 1), F.get(x, i + 2)).alias("h"), i.alias("i")))
        return let(F.sort_array(windows), lambda s: let(marked(s), covered))

    return F.when(F.size(w) >= 4, of(w)).otherwise(0)


def _bulleted(x: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.ltrim(x, F.lit(ASCII_SPACE)).startswith(m) for m in BULLETS])


def _trails_off(x: Column) -> Column:
    end = F.rtrim(x, F.lit(ASCII_SPACE))
    return end.endswith("...") | end.endswith("…")


def text_signals(text_col: Column) -> Column:
    """A struct of the ``SIGNALS`` (long) of a text.  Null text: no words, no lines.

    Words, lines and the struct itself are bound with ``let``: wherever the optimizer moves
    this expression (a filter pushed below a projection copies it), each is computed once."""
    def counts(text: Column, w: Column, lines: Column) -> Column:
        lowered = F.split(ascii_lower(text), r"[\x20\x09-\x0D.,;:!?]+")
        signals = {
            "n_words": F.size(w),
            "word_chars": F.char_length(F.array_join(w, "")),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeat_words(w),
            "n_shouts": F.regexp_count(text, F.lit(SHOUTS)),
            "n_stop_words": F.size(F.filter(lowered, lambda x: x.isin(STOP_WORDS))),
            "n_lines": F.size(lines),
            "n_bullet_lines": F.size(F.filter(lines, _bulleted)),
            "n_ellipsis_lines": F.size(F.filter(lines, _trails_off)),
        }
        return F.struct(*[signals[s].cast("long").alias(s) for s in SIGNALS])

    def lines_of(text: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")

    return let(F.coalesce(text_col, F.lit("")), lambda t: let(words(t), lambda w: let(
        lines_of(t), lambda lines: counts(t, w, lines))))


def failed_rules(signals: Column, rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that reject, in table order."""
    return F.array_compact(F.array(*[F.when(r.rejects(signals), F.lit(r.name)) for r in rules]))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES, text_col: str = "text") -> DataFrame:
    """Add the signals, ``failed_rules`` (names of the rules that reject, in table order)
    and ``kept``.

    Defined results: a null or empty text has no words and fails ``too_short``; repeated
    rows are judged alike; an empty table gives an empty table; input columns with the
    name of a signal or of ``failed_rules``/``kept`` are replaced."""
    added = [*SIGNALS, "failed_rules", "kept"]
    judged = docs.select("*", text_signals(F.col(text_col)).alias("__signals"))
    failed = failed_rules(F.col("__signals"), rules)
    return judged.select(
        *[c for c in docs.columns if c not in added], *[F.col("__signals")[s].alias(s) for s in SIGNALS],
        failed.alias("failed_rules"), (F.size(failed) == 0).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES, text_col: str = "text") -> DataFrame:
    """The documents no rule rejects, with their own columns only (map-only, no shuffle)."""
    return docs.where(let(text_signals(F.col(text_col)), lambda s: F.size(failed_rules(s, rules))) == 0)
