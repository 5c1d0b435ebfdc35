"""Column expressions for text: whitespace, cleaning, names, codes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from lexroll.profile import NODE_WORDS, REGEX_FLAGS, TAXONOMY_WORDS, CleanRules, NameRules

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


BLANKS_BEFORE = r"\s*"
SPACES = r"(?U)[\s\x1c-\x1f]+"
UNEVEN = r"(?U)[\s\x1c-\x1f&&[^ ]]|  "  # white space other than single blanks
SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def normalise(text: Column) -> Column:
    """Every run of white space becomes one blank; no blanks at the ends."""
    return let(text, lambda x: F.trim(F.when(x.rlike(UNEVEN), F.regexp_replace(x, SPACES, " ")).otherwise(x)))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.trim(text, F.lit(SPACE_CHARACTERS))


def blank_to_null(text: Column) -> Column:
    return F.when(strip(text) != "", text)


def capitalise(text: Column) -> Column:
    """First letter upper, all others lower (not word by word)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def clean_item(text: Column, rules: CleanRules = CleanRules()) -> Column:
    """Drop control characters and the ordered removals, one list marker, stray marks."""
    def remove(raw: Column) -> Column:
        bare = F.regexp_replace(raw, rules.control, "")
        kept = reduce(lambda x, rule: F.regexp_replace(x, rules.flags + rule, ""), rules.removals, bare)
        # most texts have nothing to remove; to see that, blanks before a match do not matter
        looks = [rules.flags + rule.removeprefix(BLANKS_BEFORE) for rule in rules.removals]
        found = reduce(lambda x, look: x | raw.rlike(look), looks, raw.rlike(rules.control))
        return F.when(found, kept).otherwise(raw)

    def space(unmarked: Column) -> Column:
        return F.when(unmarked.rlike("\t|  "), F.regexp_replace(unmarked, r"[ \t]+", " ")).otherwise(unmarked)

    removed = let(F.coalesce(text, F.lit("")), remove)
    unmarked = F.regexp_replace(removed, "(?U)" + rules.marker, "")
    return strip(F.rtrim(strip(let(strip(unmarked), space)), F.lit(";,")))


def abbreviate(name: Column, rules: NameRules = NameRules()) -> Column:
    """Initials of the words that carry meaning.

    Blank gives the blank mark; a name all in capitals gives its first word; a name of
    stop words only gives the first three letters.
    """
    stop = F.array(*[F.lit(w) for w in rules.stop_words])

    def of_words(words: Column) -> Column:
        # upper-case words have a cased letter, and no lower-case one
        shouted = F.forall(words, lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w)))
        telling = F.filter(words, lambda w: (w != "") & ~F.array_contains(stop, F.lower(w)))
        initials = F.array_join(F.transform(telling, lambda w: F.upper(F.substring(w, 1, 1))), "")
        mark = let(initials, lambda i: F.when(i != "", i).otherwise(F.upper(F.substring(words[0], 1, 3))))
        return F.when(shouted, words[0]).otherwise(mark)

    def of_name(plain: Column) -> Column:
        blank = F.coalesce(plain, F.lit("")) == ""
        split = let(F.split(plain, r"(?U)[\s\-]+"), of_words)
        return F.when(blank, F.lit(rules.blank_abbreviation)).otherwise(split)

    return let(normalise(name), of_name)


def nominative(phrase: Column, rules: NameRules = NameRules()) -> Column:
    """Swap the ending of the whole phrase by the first rule that fits."""
    result = phrase
    for ending, instead in reversed(rules.endings):
        cut = F.concat(F.substr(phrase, F.lit(1), F.length(phrase) - len(ending)), F.lit(instead))
        result = F.when(F.endswith(F.lower(phrase), F.lit(ending)), cut).otherwise(result)
    return result


def split_name(name: Column, rules: NameRules = NameRules()) -> Column:
    """STRUCT<main, parent>: cut before the first keyword, in order of the keyword list."""

    def cut(full: Column) -> Column:
        hits = [
            F.nullif(F.regexp_instr(full, F.lit(rf"{REGEX_FLAGS}\b\Q{word}\E\b")), F.lit(0))
            for word in rules.parent_keywords
        ]
        return let(F.coalesce(*hits), lambda at: parts(full, at))

    def parts(full: Column, at: Column) -> Column:
        head = F.when(at.isNull(), full).otherwise(strip(F.substr(full, F.lit(1), at - 1)))
        tail = let(strip(F.substr(full, at)), lambda phrase: strip(nominative(phrase, rules)))
        return let(F.struct(head.alias("head"), tail.alias("tail")), named)

    def named(piece: Column) -> Column:
        head, tail = piece["head"], piece["tail"]
        return F.struct(
            F.when(head != "", head).otherwise(F.nullif(tail, F.lit(""))).alias("main"),
            F.when(head != "", tail).alias("parent"),
        )

    return let(normalise(name), cut)


def level_of(name: Column, rules: NameRules = NameRules()) -> Column:
    """Level of the first word, or "" when the word is not listed."""
    first = F.lower(F.regexp_extract(name, f"({rules.word})", 1))
    table = F.create_map(*[F.lit(x) for pair in rules.levels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, first), F.lit(""))


def safe_name(name: Column) -> Column:
    """A file-system-safe form of a name; "unnamed" when nothing is left."""
    allowed = F.regexp_replace(F.coalesce(name, F.lit("")), r'[<>:"/\\|?*]', "")
    joined = F.regexp_replace(allowed, r"(?U)[().,;\-\s/]+", "_")
    single = F.regexp_replace(F.regexp_replace(joined, "_+", "_"), r"^_+|_+\z", "")
    return let(single, lambda s: F.when(s == "", F.lit("unnamed")).otherwise(s))


def without_code(label: Column) -> Column:
    """Drop leading digits, one dot and the blanks after them."""
    return F.regexp_replace(label, r"(?U)^\d+\.?\s*", "")


def _worded(words: tuple[str, ...], *values: Column) -> Column:
    return F.concat(*[x for word, value in zip(words, values) for x in (F.lit(word), F.coalesce(value, F.lit("")))])


def taxonomy_text(name: Column, description: Column, activities: Column) -> Column:
    """The text of a taxonomy node that is embedded."""
    return _worded(TAXONOMY_WORDS, name, description, activities)


def node_block(name: Column, description: Column, activities: Column) -> Column:
    """One taxonomy node as it is shown to the model."""
    return _worded(NODE_WORDS, name, description, activities)


def percent(part: Column, total: Column) -> Column:
    """``part / total`` in percent to one decimal, exact ties of the double to even.

    Tenths are counted in whole numbers.  Only where the true ratio is a tie does the
    rounding error of the double decide, as it does when a double is printed: ``20 x`` is
    compared with an odd whole number, the sum ``16 x + 4 x`` carried with its error term.
    """
    thousands = part * 1000
    rest = thousands % total
    whole = ((thousands - rest) / total).cast("long")  # divides evenly
    twice_rest = 2 * rest
    x = part.cast("double") / total.cast("double") * F.lit(100.0)
    a, b = x * 16, x * 4
    s = a + b
    err = b - (s - a)
    tie = (2 * whole + 1).cast("double")
    above = (s > tie) | ((s == tie) & ((err > 0) | ((err == 0) & (whole % 2 == 1))))
    up = (twice_rest > total) | ((twice_rest == total) & above)
    return (whole + F.when(up, 1).otherwise(0)) / F.lit(10.0)
