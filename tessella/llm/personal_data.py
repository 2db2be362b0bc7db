"""Personal data in texts: regular expressions propose spans, checksums and ranges confirm them, words nearby adjust their scores.

All of it is column expressions. Matches come from regexp_extract_all, what lies between them from split, and the running total of
both lengths gives places in code points. Runs that a pattern may begin in anywhere are taken whole (possessive, from their
start or the end of the last match), so that a long run costs no square of its length; the matches are those of the plain pattern.

Plain kinds (email, ip, card, phone) are kept when they are confirmed, whatever their score. Further proposals (bank accounts,
social security numbers, and written forms that the plain patterns miss) are kept from a score of KEEP on, unless they meet a plain span or a further
one that is better (a higher score, then the earlier kind and start). A confirmed further proposal is compared with all spans of its text.

Defined results: a null text counts as empty (no spans, the hash of the empty string); repeated rows give repeated
results; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BEFORE, AFTER = 40, 20  # code points on either side in which words count
KEEP = 60

# fixed values: lengths of international bank account numbers and the countries that use them
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL", 19: "MK SI", 20: "AT BA EE KZ XK LT LU", 21: "CR HR LV LI CH", 22: "BH BG GE DE IE ME RS GB VA",
    23: "GI IL AE TL", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "PT ST", 26: "IS TR", 27: "FR GR IT MR MC SM", 28: "AL AZ CY DO GT HU LB PL",
    29: "BR PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:[\\x20-]?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + ")"
SPELLED = r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT|@) ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(] ?(?:dot|DOT|\.) ?[\])]|\.) ?[A-Za-z0-9-]{1,63})+"
IP6 = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
GROUPED = r"[0-9]{4}(?:[\x20./_-]?[0-9]{4}){3}"
NATIONAL = r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}"
DIGITS = "[0-9]{3}|[0-9][\\x20-][0-9]"  # all that hold many digits hold three or more in a row, or two with one sign between
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

# words nearby that make a kind likelier, and those that make it less likely
LIKELY = {
    "email": "mail|e-mail|email|contact|write|correo|courriel|kontakt",
    "ip": "ip|address|host|server|login|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|payment|tarjeta|carte|karte|kreditkarte",
    "phone": "tel|phone|telephone|call|mobile|cell|fax|whatsapp|telefon|handy|telefono|movil|portable",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social|security|taxpayer|insurance",
}
UNLIKELY = {"ip": "version|release", "card": "order|invoice|serial|tracking|isbn", "phone": "order|invoice|serial|part|isbn", "ssn": "order|invoice|part|serial"}


def running(sizes: Column, block: int = 128) -> Column:
    """Running totals of an array of numbers: within blocks, then blocks behind one another, so that no total is copied for every element."""
    none = F.array().cast("array<bigint>")
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    grow = lambda acc, x: F.concat(acc, F.array(last(acc) + x))
    blocks = F.transform(F.sequence(F.lit(1), F.size(sizes), F.lit(block)), lambda s: F.aggregate(F.slice(sizes, s, block), none, grow))
    return F.when(F.size(sizes) == 0, none).otherwise(F.aggregate(blocks, none, lambda acc, b: F.concat(acc, F.transform(b, lambda x: x + last(acc)))))


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str, worth: Column) -> Column:
    """The pattern's leftmost matches that do not overlap, in order: structs of what they are (w), start and end (exclusive) in code points.

    worth: a cheaper condition that every text with a match meets.
    """
    def placed(both):
        ends = running(F.transform(both, lambda x: x["n"]))
        return F.zip_with(both, ends, lambda x, end: F.struct(x["w"].alias("w"), (end - F.length(x["w"])).alias("start"), end.alias("end")))

    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.zip_with(gaps, found, lambda g, w: F.struct(w.alias("w"), (F.length(g) + F.coalesce(F.length(w), F.lit(0))).cast("long").alias("n")))
    none = F.array().cast("array<struct<w:string,start:bigint,end:bigint>>")
    return F.when(worth & text.rlike(pattern), F.filter(_once(both, placed), lambda x: x["w"].isNotNull())).otherwise(none)  # no match is behind the last gap


def _digits(w: Column) -> Column:
    return F.regexp_replace(w, "[^0-9]", "")


def _in_range(part: Column) -> Column:
    """A number, leading zeros or not, of at most 255."""
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


def _mod97(w: Column) -> Column:
    """The remainder of a bank account number, its first four signs moved behind the others and letters read as 10 to 35."""
    bare = F.regexp_replace(w, "[^A-Z0-9]", "")
    signs = F.split(F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4)), "")
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    return F.aggregate(signs, F.lit(0), lambda acc, c: ((acc * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int"))


def _issued(digits: Column) -> Column:
    """Sixteen digits that begin like a card's and pass its check digit."""
    return digits.rlike("^(?:4|5[1-5]|2[2-7]|6011|65|35)") & F.call_function("luhn_check", digits)


def _near(text: Column, start: Column, end: Column, words: str) -> Column:
    side = lambda s: s.rlike(f"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")
    first = F.greatest(start - BEFORE, F.lit(0))
    return side(F.substring(text, (first + 1).cast("int"), (start - first).cast("int"))) | side(F.substring(text, (end + 1).cast("int"), F.lit(AFTER)))


def _alone(text: Column, x: Column, neighbours: str) -> Column:
    """Neither the sign before nor the one behind is one of the neighbours."""
    return ~F.coalesce(F.substring(text, x["start"].cast("int"), F.when(x["start"] > 0, 1).otherwise(0)).rlike(neighbours), F.lit(False)) & ~F.substring(text, (x["end"] + 1).cast("int"), F.lit(1)).rlike(neighbours)


def _spans(text: Column, kind: str, base: bool, found: Column, confirmed, score: int | Column) -> Column:
    """Scored spans of the confirmed matches."""
    def span(x):
        own = score(x) if callable(score) else F.lit(score)
        likely = F.when(_near(text, x["start"], x["end"], LIKELY[kind]), 30).otherwise(0)
        less = F.when(_near(text, x["start"], x["end"], UNLIKELY[kind]), -40).otherwise(0) if kind in UNLIKELY else F.lit(0)
        total = F.greatest(F.least(own + likely + less, F.lit(100)), F.lit(0))
        return F.struct(F.lit(KINDS.index(kind)).alias("k"), x["start"].alias("start"), x["end"].alias("end"), total.cast("int").alias("score"), F.lit(base).alias("base"), x["w"].alias("w"))

    return F.transform(F.filter(found, confirmed), span)


def _plain(text: Column) -> list[Column]:
    size = lambda x: F.length(_digits(x["w"]))
    card = lambda x: size(x).between(13, 19) & F.call_function("luhn_check", _digits(x["w"]))
    return [
        _spans(text, "email", True, matches(text, EMAIL, F.contains(text, F.lit("@"))), lambda x: F.lit(True), 70),
        _spans(text, "ip", True, matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda x: F.forall(F.split(x["w"], r"\."), _in_range), 60),
        _spans(text, "card", True, matches(text, CARD, text.rlike(DIGITS)), card, 60),
        _spans(text, "phone", True, matches(text, PHONE, F.contains(text, F.lit("+"))), lambda x: size(x).between(9, 15), 60),
    ]


def _further(text: Column) -> list[Column]:
    serial = lambda x: ~x["w"].rlike("^(?:000|666|9)|-00-|-0000$")
    return [
        _spans(text, "email", False, matches(text, SPELLED, text.rlike(r"[\[(] ?(?:at|AT|@) ?[\])]")), lambda x: F.lit(True), 70),
        _spans(text, "ip", False, matches(text, IP6, text.rlike(":[0-9A-Fa-f]{1,4}:")), lambda x: _alone(text, x, "[A-Za-z0-9:]"), 70),
        _spans(text, "card", False, matches(text, GROUPED, text.rlike(DIGITS)), lambda x: _alone(text, x, "[A-Za-z0-9]") & _issued(_digits(x["w"])), 60),
        _spans(text, "phone", False, matches(text, NATIONAL, text.rlike(DIGITS)), lambda x: _alone(text, x, "[A-Za-z0-9+]"), lambda x: F.when(x["w"].rlike(r"^\([0-9]{3}\)"), 60).otherwise(40)),
        _spans(text, "iban", False, matches(text, IBAN, text.rlike("[A-Z]{2}[0-9]{2}")), lambda x: _alone(text, x, "[A-Za-z0-9]") & (_mod97(x["w"]) == 1), 80),
        _spans(text, "ssn", False, matches(text, SSN, text.rlike("[0-9]-[0-9]")), lambda x: _alone(text, x, "[A-Za-z0-9-]") & serial(x), 40),
    ]


def find(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and `found`: every text's spans in the order of kind and start, as structs of kind, start and end (exclusive, in code points), score (0 to 100), base and w, the text found."""
    text = F.col("text_")
    plain = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text_")).withColumn("plain_", F.concat(*_plain(text)))
    more = plain.withColumn("more_", F.filter(F.concat(*_further(text)), lambda x: x["score"] >= KEEP))

    def meets(x, y):
        return (x["start"] < y["end"]) & (y["start"] < x["end"])

    def better(x, y):
        return (y["score"] > x["score"]) | ((y["score"] == x["score"]) & (F.struct(y["k"], y["start"]) < F.struct(x["k"], x["start"])))

    free = F.filter("more_", lambda x: ~F.exists("plain_", lambda y: meets(x, y)) & ~F.exists("more_", lambda y: meets(x, y) & better(x, y)))
    spans = F.array_sort(F.concat("plain_", F.when(F.size("more_") > 0, free).otherwise(F.col("more_"))))
    names = F.array(*map(F.lit, KINDS))
    return more.select(*keep, F.transform(spans, lambda x: F.struct(F.get(names, x["k"]).alias("kind"), x["start"], x["end"], x["score"], x["base"], x["w"])).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone of the plain spans, base_sha256 and spans; n_added and scores follow."""
    written = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["base"])

    def of(kind):
        return F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    added = F.size(F.filter("found", lambda x: ~x["base"])).cast("long")
    scores = F.array_join(F.transform("found", lambda x: x["score"].cast("string")), ",")
    return found.select("doc_id", *map(of, KINDS[:4]), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"), added.alias("n_added"), scores.alias("scores"))
