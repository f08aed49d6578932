"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score; built-in functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.llm.spans import let, matches

#: Words that make a kind likelier near a match, and by how much.
CONTEXT_WORDS = {
    "email": "mail|contact|correo|courriel|kontakt",
    "ip": r"\bip\b|server|host|address|addr",
    "card": "card|visa|credit|debit|karte|carte|tarjeta",
    "phone": "phone|call|tel|fax|mobile|fon",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
NEARBY = 0.2


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check: every second digit from the right counts double, less 9 over 9."""

    def term(k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN's check digits are right: rotated by four, with letters as 10 to 35, it is 1 modulo 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def fold(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), fold) == 1


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _octets(x: Column) -> Column:
    parts = F.transform(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


#: Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
#: As printed or in one run; the country tells where it ends.
IBAN = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())


@dataclass(frozen=True)
class Detector:
    """A pattern, the check that confirms a match, its score before context, and what a text must have to match at all."""

    kind: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    hint: str

    def spans(self, text: Column) -> Column:
        found = F.filter(matches(text, self.pattern), lambda m: self.confirm(m["match"]))
        near = CONTEXT_WORDS[self.kind]

        def span(m: Column) -> Column:
            around = F.lower(F.concat(m["before"], F.lit(" "), m["after"]))
            score = F.round(F.lit(self.score) + F.when(around.rlike(near), NEARBY).otherwise(0.0), 2)
            return F.struct(F.lit(self.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), score.alias("score"))

        return F.when(text.rlike(self.hint), F.transform(found, span)).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>"))


# A run is tried from its first character or from where the last match ended, and is never given back: that finds the same
# matches as the plain pattern, in time that grows with the text alone, and without recursion.
DETECTORS = (
    Detector("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda x: F.lit(True), 0.7, "@"),
    Detector("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.5, r"[0-9]\.[0-9]"),
    Detector("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9])++", lambda x: let(_digits(x), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)), 0.7, r"[0-9][\x20-]?[0-9]"),
    Detector("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: F.length(_digits(x)).between(9, 15), 0.6, r"\+[0-9]"),
    Detector("iban", IBAN, lambda x: mod97(F.replace(x, F.lit(" "), F.lit(""))), 0.8, r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
)
BASE = ("email", "ip", "card", "phone")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.0, detectors: tuple[Detector, ...] = DETECTORS) -> DataFrame:
    """(id, found) for each row; found: array<struct<kind, start, end, score>> by kind as listed, then start.

    Positions count code points, end exclusive. A null or empty text has an empty array, whatever the id; repeated rows have
    equal results. Texts are read whole, in time that grows with their length and matches. Rows stay in their task: there is no
    shuffle. Other columns are not read.
    """
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(id_col, F.concat(*(d.spans(text) for d in detectors)).alias("found"))
    return rows if min_score <= 0 else rows.withColumn("found", F.filter("found", lambda s: s["score"] >= min_score))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """docs with `<kind>` in place of each span, of overlapping spans the one that starts first, then the longest."""
    text = F.coalesce(text_col, F.lit(""))
    spans = F.concat(*(d.spans(text) for d in DETECTORS))
    ordered = F.sort_array(F.transform(F.filter(spans, lambda s: s["score"] >= min_score), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("rest"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct((-s["rest"]).alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out")))
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))))
