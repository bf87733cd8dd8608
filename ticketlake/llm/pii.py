"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is a row-local expression: no shuffle, no Python. Spark gives no match positions, so a
text is cut twice by one pattern: `split` gives the gaps, `regexp_extract_all` the matches, and the
running sum of their lengths is where each match starts. Patterns use possessive quantifiers, which
changes no match (no repeated class can give back a character that what follows could use) and keeps
very long runs linear; `\\G` lets a run go on right after the previous match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"
#: Code points before and after a span in which context words count.
CONTEXT_CHARS = 48
#: Code points of a piece of a long text, and elements of a block of a running total.
PIECE_CHARS, SCAN_BLOCK = 256, 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a text of digits."""
    def add(total: Column, at: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - at, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(at % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def valid_email(match: Column) -> Column:
    return F.lit(True)


def valid_ip(match: Column) -> Column:
    """Every part is at most 255, leading zeros aside."""
    def fits(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), fits)


def valid_card(match: Column) -> Column:
    """12 to 19 digits that pass Luhn."""
    digits = _digits(match)
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def valid_phone(match: Column) -> Column:
    """9 to 15 digits."""
    return F.length(_digits(match)).between(9, 15)


def valid_iban(match: Column) -> Column:
    """15 to 34 characters whose ISO 7064 mod 97-10 remainder is 1."""
    bare = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.length(bare).between(15, 34) & (F.aggregate(F.split(moved, ""), F.lit(0), add) == 1)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. `hint` is a cheap test that a text without a match mostly fails."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str


#: In the order in which spans that start together are listed.
KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: t.contains("@"), valid_email, 0.8, "e-?mail|mail|contact|write"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.contains("."), valid_ip, 0.6, "ip|address|server|host|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda t: t.isNotNull(), valid_card, 0.6, "card|credit|debit|visa|payment|carte|karte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda t: t.contains("+"), valid_phone, 0.6, "phone|tel|call|mobile|fax|telefon"),
]
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HN HU LB NI PL SV",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """An IBAN of its country's length, so that a word after it stays out; else one of any length."""
    def groups(length: int) -> str:
        fours, rest = divmod(length - 4, 4)
        return r"(?:\x20?[A-Z0-9]{4}){%d}" % fours + (r"\x20?[A-Z0-9]{%d}" % rest if rest else "")

    exact = "|".join(
        rf"(?:{names.replace(' ', '|')})[0-9]{{2}}{groups(n)}(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items())
    other = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{exact}|{other})"


#: What the method adds to the base kinds.
ADDED_KINDS = [
    Kind("iban", iban_pattern(),
         lambda t: t.isNotNull(), valid_iban, 0.9, "iban|account|bank|konto|compte|cuenta"),
]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of ints, `combine` over those before it, from 0; `combine` is associative.

    An array that grows by one element is copied, so the array is worked on in blocks: the totals of
    blocks are combined first, then each block by itself.
    """
    def scan(part: Column, start: Column) -> Column:
        def step(state: Column, value: Column) -> Column:
            return F.struct(
                combine(state["now"], value).alias("now"), F.concat(state["found"], F.array(state["now"])).alias("found"))

        return F.aggregate(part, F.struct(start.alias("now"), F.array().cast("array<int>").alias("found")), step)["found"]

    def in_blocks(whole: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(whole), F.lit(SCAN_BLOCK))
        return let(F.transform(starts, lambda at: F.slice(whole, at, F.lit(SCAN_BLOCK))), lambda blocks: F.flatten(F.zip_with(
            blocks, scan(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), combine)), F.lit(0)), scan)))

    return let(values, lambda whole: F.when(F.size(whole) == 0, F.array().cast("array<int>")).otherwise(in_blocks(whole)))


def pieces(text: Column) -> Column:
    """The text in pieces of `PIECE_CHARS` code points; a place in it is found without passing all before."""
    return F.when(F.length(text) <= PIECE_CHARS, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit("(?s).{1,%d}+" % PIECE_CHARS), F.lit(0)))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points from `start` to before `end` of a text in `pieces`; both may lie beyond its end."""
    first = F.floor(start / PIECE_CHARS).cast("int")
    last = F.greatest(F.floor((end - 1) / PIECE_CHARS).cast("int"), first)
    there = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.substring(there, start - first * PIECE_CHARS + 1, F.greatest(end - start, F.lit(0)))


def _positions(kind: Kind, text: Column) -> Column:
    """Structs `(start, value)` of every match of the kind's pattern, validated or not."""
    gaps = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # the last gap has no match after it
    pairs = F.filter(
        F.zip_with(matches, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("value"))),
        lambda pair: pair["value"].isNotNull())

    def placed(found: Column) -> Column:
        ends = running(F.transform(found, lambda p: p["gap"] + F.length(p["value"])), lambda x, y: x + y)
        return F.zip_with(found, ends, lambda p, at: F.struct((at + p["gap"]).alias("start"), p["value"].alias("value")))

    return let(pairs, placed)


def kind_spans(kind: Kind, text: Column) -> Column:
    """Spans of one kind in a text column, with their scores.

    The score is the kind's own, plus 0.15 where one of its context words stands nearby, less 0.2
    where the span touches a letter; it lies between 0 and 1. The work grows with the text and with the
    matches, not with their product.
    """
    def span(parts: Column, found: Column) -> Column:
        start, value = found["start"], found["value"]
        end = start + F.length(value)
        before = cut(parts, F.greatest(start - CONTEXT_CHARS, F.lit(0)), start)
        after = cut(parts, end, end + CONTEXT_CHARS)
        near = F.concat(before, F.lit(" "), after).rlike(rf"(?i)\b(?:{kind.words})\b")
        touched = before.rlike(r"\p{L}$") | after.rlike(r"^\p{L}")
        score = kind.score + F.when(near, 0.15).otherwise(0.0) - F.when(touched, 0.2).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"),
            F.round(F.least(score, F.lit(1.0)), 3).alias("score"))

    proposed = F.filter(_positions(kind, text), lambda found: kind.valid(found["value"]))
    none = F.array().cast(SPAN)
    spans = let(proposed, lambda all_: F.when(F.size(all_) == 0, none).otherwise(
        let(pieces(text), lambda parts: F.transform(all_, lambda found: span(parts, found)))).cast(SPAN))
    # the digits test is cheap next to the patterns, and every kind but email needs digits
    hint = kind.hint(text) if kind.name == "email" else kind.hint(text) & text.rlike("[0-9]")
    return F.when(hint, spans).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", kinds: list[Kind] | None = None, out: str = "pii") -> DataFrame:
    """`docs` with the array column `out`: every validated span, by start, then kind in list order.

    Positions are code points, end exclusive. A null or empty text has no spans; whole texts are
    searched, in time that grows with their length. A column that is already named `out` is replaced; repeated rows stay repeated;
    an empty table gives an empty one.
    """
    kinds = KINDS + ADDED_KINDS if kinds is None else kinds
    order = F.create_map(*[F.lit(x) for i, kind in enumerate(kinds) for x in (kind.name, i)])
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = F.concat(*[kind_spans(kind, whole) for kind in kinds])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("order"), s.alias("span")))
    return docs.withColumn(out, F.transform(F.array_sort(keyed), lambda k: k["span"]))


def masked(text: Column, spans: Column, least: float = 0.0) -> Column:
    """The text with every span of at least that score replaced by its kind, as in `[EMAIL]`.

    Of spans that overlap, the first one's name stands and the mask covers all of them. The spans are
    ordered by start, as `find_pii` gives them.
    """
    def replaced(kept: Column, parts: Column) -> Column:
        reach = running(F.transform(kept, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        shown = F.zip_with(kept, reach, lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(
            F.concat(cut(parts, at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        end = F.array_max(F.transform(kept, lambda s: s["end"]))
        return F.concat(F.array_join(shown, ""), cut(parts, end, F.size(parts) * PIECE_CHARS))

    return let(F.filter(spans, lambda s: s["score"] >= least), lambda kept: F.when(F.size(kept) == 0, text).otherwise(
        let(pieces(text), lambda parts: replaced(kept, parts))))


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
