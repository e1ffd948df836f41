"""Numbers that a text states about a label, read by places and tokens.

A text is cut at the places of a label. What follows one (its reach) or comes before
it is then read token by token: the first number, the unit after it, the first
percentage further on and the direction word right before that, each within the
distance that the kind of statement allows. Full-width digits are digits.

Cases: a null text or label states nothing; of several places the first that states
all parts counts, then the first that states a level; a number in the tokens that is
none (two points) is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .numbers import let

#: Direction words, those that make a percentage negative, states, and comparisons.
CN_WORDS = ("增长", "下降", "上升", "减少", "提高", "回落", "上涨", "下跌", "降低", "放缓", "收窄", "扩大")
CN_NEGATIVE = ("下降", "减少", "下跌", "降低", "放缓", "收窄")
EN_WORDS = (
    "rose", "fell", "increased", "decreased", "climbed", "dropped", "edged up", "edged down", "was unchanged", "was flat", "jumped", "slumped", "grew",
    "contracted", "advanced", "retreated", "accelerated", "slowed", "down", "up",
)
EN_NEGATIVE = ("fell", "decreased", "dropped", "edged down", "was unchanged", "was flat", "slumped", "contracted", "retreated", "slowed", "down")
STATES_EN = ("was", "stood at", "at", "is", "of", "remain", "to be", "to remain")
#: The most characters between label and number, number and change, label and change, and around a state.
TO_LEVEL, LEVEL_TO_CHANGE, TO_CHANGE_CN, TO_CHANGE_EN, TO_VALUE_CN, TO_STATE, STATE_TO_VALUE = 8, 40, 60, 80, 10, 30, 20
#: How a percentage ends, the lines of the GDP table, and its numbers.
PERCENT_EN = r"(?:%(?:\s*YoY)?|\bpercent(?:age)?(?:\s+points?)?\b)"
TABLE_ROW = r"総\s*生\s*産.*Ｇ\s*Ｄ\s*Ｐ"
TABLE_NUMBER = r"[-−－–]?\d+\.?\d*"

REACH = 400  # characters after a label that are looked at, several times the sum of all distances
SPACE = " \t\n\r\x0b\x0c"


def folded(text: Column) -> Column:
    """Text with full-width digits as plain ones."""
    return F.translate(text, "０１２３４５６７８９", "0123456789")


def number(text: Column) -> Column:
    """A number with commas; null if it is none."""
    return F.replace(F.trim(folded(text)), F.lit(","), F.lit("")).try_cast("double")


def signed(pct: Column, word: Column, negative: tuple[str, ...]) -> Column:
    """Negative after a falling word, whatever its case (never -0.0)."""
    return F.when(F.lower(word).isin(*negative), -F.abs(pct)).otherwise(pct) + F.lit(0.0)


def first(items: Column, good) -> Column:
    return F.get(F.filter(items, good), F.lit(0))


def pieces(text: Column, label: str, any_case: bool) -> Column:
    return F.split(text, ("(?i)" if any_case else "") + f"\\Q{label}\\E")


def following(text: Column, label: str, any_case: bool = False) -> Column:
    """What follows each place of a label, up to REACH characters (which further places may stand in)."""
    most = REACH // max(1, len(label)) + 1

    def after(parts: Column) -> Column:
        at = F.sequence(F.lit(2), F.size(parts))
        return F.transform(at, lambda i: F.substring(F.array_join(F.slice(parts, i, F.lit(most)), label), 1, REACH))

    none = F.array().cast("array<string>")
    return let(pieces(text, label, any_case), lambda p: F.when(F.size(p) > 1, after(p)).otherwise(none))


def preceding(text: Column, label: str) -> Column:
    """What stands right before each place of a label, up to 60 characters back."""
    return let(pieces(text, label, True), lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: F.substring(F.rtrim(x, F.lit(SPACE)), -60, 60)))


def one_of(words: tuple[str, ...]) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


def change(text: Column, token: str, mark: str, words: tuple[str, ...], leads: tuple[str, ...], reach: int) -> Column:
    """The first percentage (token, then mark): its digits and the direction right before it; null if what belongs to it starts beyond `reach`."""
    belongs = rf"(?i)(?:{one_of(leads)})?\s*({one_of(words)})?\s*$"

    def read(hit: Column) -> Column:
        def place(before: Column) -> Column:
            start = F.length(before) - F.length(F.regexp_extract(before, belongs, 0))
            return F.when((hit != "") & (start <= reach), F.struct(F.regexp_extract(hit, token, 0).alias("digits"), F.regexp_extract(before, belongs, 1).alias("word")))

        return let(F.call_function("substring_index", text, hit, F.lit(1)), place)

    return let(F.regexp_extract(text, f"(?i){token}\\s*{mark}", 0), read)


def change_cn(text: Column, reach: int) -> Column:
    return change(text, "[-0-9.]+", "%", CN_WORDS, ("同比",), reach)


def change_en(text: Column, reach: int) -> Column:
    return change(text, r"[-+]?\d+\.?\d*", PERCENT_EN, EN_WORDS, ("yoy", "year-on-year", "year on year"), reach)


def level(text: Column, unit: str) -> Column:
    """(digits, rest): the number near the start of text that the unit follows, and what comes after."""

    def read(lead: Column) -> Column:
        def split(after: Column) -> Column:
            digits = F.regexp_extract(after, r"^[0-9,]+\.?[0-9]*", 0)
            rest = lambda d: F.ltrim(after.substr(F.length(d) + 1, F.length(after)), F.lit(SPACE))
            ok = lambda d: (d != "") & (F.length(lead) <= TO_LEVEL) & rest(d).startswith(unit)
            return let(digits, lambda d: F.when(ok(d), F.struct(d.alias("digits"), F.substring(rest(d), len(unit) + 1, REACH).alias("rest"))))

        return let(text.substr(F.length(lead) + 1, F.length(text)), split)

    return let(F.rtrim(F.regexp_extract(text, "^[^0-9]*", 0), F.lit(",")), read)


def stated(value: Column | None = None, change: Column | None = None) -> Column:
    """What a statement says: (value, change)."""
    none = F.lit(None).cast("double")
    return F.struct((none if value is None else value).alias("value"), (none if change is None else change).alias("change"))


def level_and_change(text: Column, label: str, unit: str) -> Column:
    """Level and signed change after a label: of the first place with both, else the first with a level."""

    def read(window: Column) -> Column:
        both = lambda v: F.struct(v["digits"].alias("digits"), change_cn(v["rest"], LEVEL_TO_CHANGE).alias("change"))
        return let(level(window, unit), lambda v: F.when(v.isNotNull(), both(v)))

    best = lambda found: F.coalesce(first(found, lambda x: x["change"].isNotNull()), first(found, lambda x: x.isNotNull()))
    say = lambda x: stated(number(x["digits"]), signed(number(x["change"]["digits"]), x["change"]["word"], CN_NEGATIVE))
    return let(let(F.transform(following(text, label), read), best), say)


def change_after(text: Column, label: str, english: bool) -> Column:
    read = (lambda w: change_en(w, TO_CHANGE_EN)) if english else (lambda w: change_cn(w, TO_CHANGE_CN))
    best = first(F.transform(following(text, label, any_case=english), read), lambda x: x.isNotNull())
    return let(best, lambda x: stated(change=signed(number(x["digits"]), x["word"], EN_NEGATIVE if english else CN_NEGATIVE)))


def value_at(text: Column, token: str, unit: str, near) -> Column:
    """The first number (token) of text, if the unit follows it and `near` holds for what stands before it."""

    def read(digits: Column) -> Column:
        rest = F.substring(text, F.length(F.call_function("substring_index", text, digits, F.lit(1))) + F.length(digits) + 1, F.lit(REACH))
        ok = F.lower(F.ltrim(rest, F.lit(SPACE))).startswith(unit.lower()) & let(F.call_function("substring_index", text, digits, F.lit(1)), near)
        return F.when((digits != "") & ok, digits)

    return let(F.regexp_extract(text, token, 0), read)


def value_cn(text: Column, label: str, unit: str) -> Column:
    """The number right after 为, which follows the label closely with no digit between."""
    bare = lambda gap: F.rtrim(gap, F.lit(SPACE))
    near = lambda gap: bare(gap).endswith("为") & (F.length(bare(gap)) - 1 <= TO_VALUE_CN)
    found = F.transform(following(text, label), lambda w: value_at(w, "[.]*[0-9][0-9.]*", unit, near))
    return stated(value=number(first(found, lambda x: x.isNotNull())))


def value_en(text: Column, label: str, unit: str) -> Column:
    """The number after a state (was, at, ..) close to the label, with no digit between."""
    near = lambda gap: gap.rlike(rf"(?is)^.{{0,{TO_STATE}}}(?:{one_of(STATES_EN)}).{{0,{STATE_TO_VALUE}}}$")
    found = F.transform(following(text, label, any_case=True), lambda w: value_at(w, "[-.]*[0-9][-0-9.]*", unit, near))
    return stated(value=number(first(found, lambda x: x.isNotNull())))


def percent_at_end(text: Column) -> Column:
    """The digits of a percentage that a text ends with; null if it does not."""
    return F.nullif(F.regexp_extract(text, r"([-+]?[0-9]+\.?[0-9]*)\s*%\s*$", 1), F.lit(""))


def change_before(text: Column, label: str) -> Column:
    return stated(change=number(first(F.transform(preceding(text, label), percent_at_end), lambda x: x.isNotNull())))


def change_compared(text: Column) -> Column:
    """A percentage that is said to be lower or higher than in some period."""

    def read(piece: Column) -> Column:
        tail = F.substring(F.rtrim(piece, F.lit(SPACE)), -60, 60)
        word = F.lower(F.regexp_extract(tail, "(?i)(lower|higher)$", 1))
        return let(F.struct(tail.alias("t"), word.alias("w")), lambda x: F.when(
            x["w"] != "", F.struct(percent_at_end(F.substring(x["t"], F.lit(1), F.length(x["t"]) - F.length(x["w"]))).alias("digits"), x["w"].alias("word"))))

    cut = F.split(text, r"(?i) than\s+in\b")
    best = first(F.transform(F.slice(cut, 1, F.size(cut) - 1), read), lambda x: x["digits"].isNotNull())
    size = lambda x: F.abs(number(x["digits"]))
    return let(best, lambda x: stated(change=F.when(x["word"] == "lower", -size(x)).otherwise(size(x)) + F.lit(0.0)))


def row_numbers(text: Column, row: int) -> Column:
    """The numbers in the row-th line of the GDP table, without its cells in parentheses; empty unless two lines are there."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(TABLE_ROW))
    clean = F.regexp_replace(F.get(lines, F.lit(row)), r"\([^)]*\)", " ")
    numbers = F.transform(F.regexp_extract_all(clean, F.lit(TABLE_NUMBER), 0), lambda x: F.translate(x, "−－–", "---").try_cast("double"))
    return F.when(F.size(lines) >= 2, numbers).otherwise(F.array().cast("array<double>"))
