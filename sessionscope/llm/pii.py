"""Personal data in texts, found with built-in functions only.

Regular expressions propose spans, validators confirm them (Luhn for card
numbers, mod-97 for bank accounts, ranges for addresses, digit counts for
phone numbers), and words near a span raise or lower its score. Every rule's
matches are leftmost and do not overlap one another; a match that its
validator refuses is dropped and not tried again. Spans count characters
(code points), the end exclusive.

A long text is first cut into parts of about ``PART`` characters, at places
that no rule's match can cover (line ends, separators, a space behind a small
letter), so the work on a part stays bounded and time grows with the text. In
a part, a rule's places come from splitting it by the same expression: the
pieces between matches give every match's start. A match's surroundings are
read from the whole text cut into blocks of ``NEAR`` characters, whatever else
matches in them.

The expressions are written for a backtracking matcher: repeats are possessive
where nothing behind them could use what they give back, and a run of
characters is entered only at its first one, so time stays linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

PART = 8192  # characters of a part; one without a place to cut is longer
NEAR = 40  # characters on each side in which context words count
ACCEPT = 0.5  # added spans need this score; base spans always stay
_RAISE, _LOWER = 0.3, 0.2


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    fits = F.length(digits).between(16, 19)
    # the number is summed only if its length fits
    return F.when(fits, F.aggregate(F.sequence(F.lit(0), F.when(fits, F.length(digits)).otherwise(1) - 1),
                                    F.lit(0), add) % 10 == 0).otherwise(False)


def _mod97(match: Column) -> Column:
    letters = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(letters, F.lit(5)), F.substr(letters, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(add(rest, c))) == 1


def _octets(match: Column) -> Column:
    return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")


def _phone(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)


def _any(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Rule:
    """A kind of data: what proposes it, what confirms it, and how sure that makes us."""

    kind: str
    hint: str  # a cheap expression without which the text cannot match
    pattern: str
    confirm: object
    score: float
    context: str  # words that raise the score
    against: str  # words that lower it
    base: bool


# The length of an account number by country (IBAN registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _grouped_ibans() -> str:
    """Account numbers in groups of four, as long as their country says."""
    def groups(length: int, codes: str) -> str:
        full, rest = divmod(length - 4, 4)
        tail = rf"\x20[A-Z0-9]{{{rest}}}" if rest else ""
        return rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20[A-Z0-9]{{4}}){{{full}}}{tail}(?![A-Za-z0-9])"

    return "|".join(groups(length, codes) for length, codes in IBAN_LENGTHS.items())


RULES = (
    Rule("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.8,
         "mail|contact|write|reach", "example|noreply", True),
    Rule("ip", "[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _octets, 0.6,
         r"\bip\b|address|host|server|login", "version|release|section", True),
    Rule("card", "[0-9]", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", _luhn, 0.7,
         "card|visa|master|credit|debit|amex|payment", "order|serial|tracking|isbn", True),
    Rule("phone", r"\+", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, "phone|call|tel|mobile|fax|whatsapp", "total|sum",
         True),
    Rule("iban", "[A-Z]{2}[0-9]{2}",
         # a country's own length first: a word in capitals may stand behind the number
         rf"(?<![A-Za-z0-9])(?:{_grouped_ibans()}|"
         r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?)"
         r"(?![A-Za-z0-9]))", _mod97, 0.7, r"iban|bank|account|konto|compte|cuenta", "", False),
    Rule("ssn", "[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _any, 0.3, r"\bssn\b|social", "", False),
    Rule("secret", "[0-9]", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[A-Fa-f0-9]{16,128})(?![A-Za-z0-9])", _any, 0.3,
         "password|passwd|token|secret|api.?key|credential|akia", "sha|digest|checksum|commit", False),
)
KINDS = tuple(r.kind for r in RULES)
BASE = tuple(r.kind for r in RULES if r.base)


# A part ends behind one of these; the last one, or one without any, behind whatever follows.
_CUT = r"(?:[\n\t,;:\"'/<>!?=]|(?<=[a-z])\x20)"
_PARTS = rf"(?s).{{0,{PART - 1}}}{_CUT}|.{{{PART}}}.*?{_CUT}|.+"


def _parts(whole: Column) -> Column:
    """(at, text) of the parts of a text; no match of a rule lies in two of them."""
    texts = F.when(F.length(whole) <= PART, F.array(whole)) \
        .otherwise(F.regexp_extract_all(whole, F.lit(_PARTS), F.lit(0)))
    first = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<at:int,text:string>>").alias("parts"))

    def step(done: Column, text: Column) -> Column:
        return F.struct((done["at"] + F.length(text)).alias("at"),
                        F.concat(done["parts"], F.array(F.struct(done["at"].alias("at"), text.alias("text")))).alias("parts"))

    return F.aggregate(texts, first, step, lambda done: done["parts"])


def _matched(rule: Rule, text: Column) -> Column:
    """(start, match) of a rule's matches in a part, from the pieces around them."""
    matches = F.when(text.rlike(rule.hint), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))) \
        .otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size(matches) > 0, F.split(text, rule.pattern, -1)).otherwise(F.array().cast("array<string>"))
    first = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("found"))

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["gap"])
        return F.struct((start + F.length(piece["match"])).alias("at"),
                        F.concat(done["found"], F.array(F.struct(start.alias("start"), piece["match"].alias("match"))))
                        .alias("found"))

    # the last gap has no match behind it
    pieces = F.filter(F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match"))),
                      lambda p: p["match"].isNotNull())
    return F.aggregate(pieces, first, step, lambda done: done["found"])


_SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"


def _near(blocks: Column, at: Column) -> tuple[Column, Column]:
    """The ``NEAR`` characters before and from a place: parts of two blocks each, so the time is constant."""
    k, inside = F.floor(at / NEAR).cast("int"), (at % NEAR).cast("int")

    def block(i: Column) -> Column:
        return F.coalesce(F.get(blocks, i), F.lit(""))

    here = block(k)
    before = F.concat(F.substr(block(k - 1), inside + 1), F.substr(here, F.lit(1), inside))
    return before, F.concat(F.substr(here, inside + 1), F.substr(block(k + 1), F.lit(1), inside))


def _spans(rule: Rule, part: Column, blocks: Column) -> Column:
    """The rule's confirmed and scored spans in a part of the text."""
    def span(m: Column) -> Column:
        match, start = m["match"], part["at"] + m["start"]
        before, after = _near(blocks, start)[0], _near(blocks, start + F.length(match))[1]
        near = F.lower(F.concat(before, F.lit(" "), F.substr(match, F.lit(1), F.lit(8)), F.lit(" "), after))
        score = F.lit(rule.score) + F.when(near.rlike(rule.context), _RAISE).otherwise(0.0)
        if rule.against:
            score -= F.when(near.rlike(rule.against), _LOWER).otherwise(0.0)
        sure = rule.confirm(match)
        if not rule.base:
            sure = sure & (score >= ACCEPT)
        return F.struct(F.when(sure, F.lit(rule.kind)).alias("kind"), start.cast("long").alias("start"),
                        (start + F.length(match)).cast("long").alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    return F.filter(F.transform(_matched(rule, part["text"]), span), lambda s: s["kind"].isNotNull()) \
        .cast(f"array<{_SPAN}>")


_TEXT_PARTS, _FOUND = "parts of the text", "spans of its parts"


def _by_parts(docs: DataFrame, text: str, kept: list[Column]) -> DataFrame:
    """``kept`` with the parts of the text and, for each rule, every part's spans."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    hinted = whole.rlike("|".join(f"(?:{r.hint})" for r in RULES))
    blocks, parts = F.col("`blocks of the text`"), F.col(f"`{_TEXT_PARTS}`")
    cut = docs.select(
        *kept,
        F.when(hinted, F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{NEAR}}}"), F.lit(0))).otherwise(none)
        .alias("blocks of the text"),
        F.when(hinted, _parts(whole)).otherwise(F.array().cast("array<struct<at:int,text:string>>")).alias(_TEXT_PARTS))

    def of(rule: Rule) -> Column:
        return F.transform(parts, lambda part: _spans(rule, part, blocks)).alias(rule.kind)

    return cut.select("*", F.struct(*map(of, RULES)).alias(_FOUND)).drop("blocks of the text")


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: all spans, by kind as listed in RULES, then by start.

    A span is (kind, start, end, score). A null or empty text has no spans (an
    empty array). Rows are handled one by one: repeated rows get the same
    spans, an empty table stays empty, all columns of ``docs`` are kept but a
    column named like ``spans`` is replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != spans]
    every = F.concat(*(F.flatten(F.col(f"`{_FOUND}`.{r.kind}")) for r in RULES))
    return _by_parts(docs, text, kept).select(*kept, every.alias(spans))


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """The spans of some kinds as text: kind:start:end, joined by commas."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                               s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets, such as [email].

    Overlapping spans are replaced together, by the first one's kind. Texts
    without spans, null ones among them, stay as they are; the columns keep
    their order and types.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    found = F.col(f"`{_FOUND}`")

    def rebuilt(part: Column, i: Column) -> Column:
        whole, base = part["text"], part["at"]
        own = F.concat(*(F.get(found[r.kind], i) for r in RULES))
        ordered = F.array_sort(F.transform(own, lambda s: F.struct(
            (s["start"] - base).cast("int").alias("start"), (base - s["end"]).cast("int").alias("upto"),
            s["kind"].alias("kind"))))
        first = F.struct(F.lit(0).cast("int").alias("at"), F.lit("").alias("text"))

        def step(done: Column, s: Column) -> Column:
            clear = s["start"] >= done["at"]
            part = F.concat(done["text"], F.substr(whole, done["at"] + 1, s["start"] - done["at"]), F.lit("["), s["kind"],
                            F.lit("]"))
            return F.struct(F.greatest(done["at"], -s["upto"]).alias("at"),
                            F.when(clear, part).otherwise(done["text"]).alias("text"))

        return F.when(F.size(own) == 0, whole).otherwise(F.aggregate(
            ordered, first, step, lambda done: F.concat(done["text"], F.substr(whole, done["at"] + 1))))

    parts = F.col(f"`{_TEXT_PARTS}`")
    some = reduce(Column.__or__, (F.exists(found[r.kind], lambda spans: F.size(spans) > 0) for r in RULES))
    changed = F.when(some, F.array_join(F.transform(parts, rebuilt), "")).otherwise(F.col(f"`{text}`"))
    return _by_parts(docs, text, kept).select(*(changed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
