"""Format-preserving pseudonyms: validated numbers, dates and addresses are permuted by keyed Feistel networks.

Every value is mapped to another of its own format by a permutation that only the key determines, so equal values get
equal pseudonyms in all documents, and different values different ones. Everything is SQL functions on the JVM side.
"""

from __future__ import annotations

import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days of the 400 years from 1800 on, which the calendar repeats after: 189 * 773.
FIRST_DAY, DAY_HIGH, DAY_LOW = "1800-01-01", 189, 773

_ALONE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Patterns by kind, in the order in which they are tried; a match counts only if its kind finds it valid.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}" + _END,
    "token": _ALONE + r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})" + _END,
    "ip": r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}]|\.\d)",
    "date": r"(?<![\p{L}\p{N}./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\p{L}\p{N}]|[./-]\d)",
    "phone": r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?\d{2,4}[ .-]?\d{2,4}|\d{2,4}(?:[ .-]?\d{2,4}){1,3})(?![\p{L}\p{N}]|[.-]\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "card": _ALONE + r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})" + _END,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _hash(key: str, *parts: Column) -> Column:
    """A number of 60 bits from the key and the parts."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, high: Column, low: Column, key: str, kind: str) -> Column:
    """The pair (a, b), a < high and b < low, permuted: each half in turn is shifted by a hash of the other."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s: Column, r: Column) -> Column:
        to_a = F.pmod(s["a"] + F.pmod(_hash(key, F.lit(kind), r, high, s["b"]), high), high)
        to_b = F.pmod(s["b"] + F.pmod(_hash(key, F.lit(kind), r, low, s["a"]), low), low)
        even = r % 2 == 0
        return F.struct(F.when(even, to_a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(to_b).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    out = feistel(F.substring(digits, F.lit(1), half).cast("long"), F.substring(digits, half + 1, n).cast("long"), power(half), power(n - half), key, kind)
    return F.concat(F.lpad(out["a"].cast("string"), half, "0"), F.lpad(out["b"].cast("string"), n - half, "0"))


def _filled(format_: Column, digits: Column) -> Column:
    """``format_`` with its digits replaced one by one by ``digits``."""
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["text"], F.substring(digits, s["at"], F.lit(1))).alias("text"), (s["at"] + 1).alias("at"))).otherwise(
        F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at")))
    return F.aggregate(F.split(format_, ""), F.struct(F.lit("").alias("text"), F.lit(1).alias("at")), step)["text"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that completes a string of digits."""
    each = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10).otherwise(c.cast("int")))
    total = F.aggregate(each, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    fresh = _permuted_digits(payload, key, "card")
    valid = F.substring(digits, F.length(digits), F.lit(1)) == luhn_digit(payload)
    return F.when(valid, _filled(value, F.concat(fresh, luhn_digit(fresh))))


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    digits = _digits(rest)
    return F.when(F.length(_digits(value)).between(8, 15), F.concat(country, _filled(rest, _permuted_digits(digits, key, "phone"))))


def _ssn(value: Column, key: str) -> Column:
    """Areas are 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999; numbers that are none stay."""
    area, group, serial = (F.split(value, "-")[k].cast("long") for k in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    out = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    fresh = F.when(out["a"] >= 665, out["a"] + 2).otherwise(out["a"] + 1)
    parts = ((fresh, 3), (F.floor(out["b"] / 9999) + 1, 2), (out["b"] % 9999 + 1, 4))
    return F.when(valid, F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts]))


def _ip(value: Column, key: str) -> Column:
    part = [F.split(value, r"\.")[k].cast("long") for k in range(4)]
    valid = F.greatest(*part) <= 255
    out = feistel(part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536), F.lit(65536), key, "ip")
    fresh = [F.floor(out["a"] / 256), out["a"] % 256, F.floor(out["b"] / 256), out["b"] % 256]
    return F.when(valid, F.concat_ws(".", *[f.cast("long").cast("string") for f in fresh]))


def _date(value: Column, key: str) -> Column:
    iso = value.rlike("^[0-9]{4}-")
    first, second, year = F.substring(value, 1, 2), F.substring(value, 4, 2), F.substring(value, 7, 4)
    month_first = value.rlike("^[0-9]{2}/") & (second > "12")  # only so is it a date
    text = F.when(iso, value).when(month_first, F.concat_ws("-", year, first, second)).otherwise(F.concat_ws("-", year, second, first))
    day = F.datediff(text.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    out = feistel(F.floor(day / DAY_LOW), day % DAY_LOW, F.lit(DAY_HIGH), F.lit(DAY_LOW), key, "date")
    fresh = F.date_add(F.lit(FIRST_DAY).cast("date"), (out["a"] * DAY_LOW + out["b"]).cast("int")).cast("string")
    mark = F.substring(value, 3, 1)
    of_day, of_month = F.substring(fresh, 9, 2), F.substring(fresh, 6, 2)
    turned = F.concat(F.when(month_first, of_month).otherwise(of_day), mark, F.when(month_first, of_day).otherwise(of_month), mark, F.substring(fresh, 1, 4))
    return F.when(day.between(0, DAY_HIGH * DAY_LOW - 1), F.when(iso, fresh).otherwise(turned))


def _by_class(text: Column, key: str, kind: str, letters: int) -> Column:
    """A string whose digits and ASCII letters are shifted within digits, upper and lower case: halves in turn.

    Hashes do not tell case apart, so a value keeps its link in other case. Other characters stay.
    """
    half = F.floor(F.length(text) / 2).cast("int")

    def shifted(mine: Column, other: Column, r: Column) -> Column:
        bits = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), F.lower(other)), 512)  # 42 shifts, more than a half has

        def one(c: Column, i: Column) -> Column:
            by = F.conv(F.substring(bits, (i * 3) % 126 + 1, F.lit(3)), 16, 10).cast("int")
            within = lambda first, size: F.chr(F.ascii(F.lit(first)) + (F.ascii(c) - F.ascii(F.lit(first)) + by) % size)
            return F.when(c.rlike("^[0-9]$"), within("0", 10)).when(c.rlike("^[a-z]$"), within("a", letters)).when(c.rlike("^[A-Z]$"), within("A", letters)).otherwise(c)

        return F.array_join(F.transform(F.split(mine, ""), one), "")

    def turn(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        return F.struct(F.when(even, shifted(s["a"], s["b"], r)).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise(shifted(s["b"], s["a"], r)).alias("b"))

    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b"))
    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return F.concat(out["a"], out["b"])


def _email(value: Column, key: str) -> Column:
    return F.concat(_by_class(F.substring_index(value, "@", 1), key, "email", 26), F.lit("@"), F.substring_index(value, "@", -1))


def _token(value: Column, key: str) -> Column:
    return F.when(value.rlike("[0-9]") & value.rlike("[A-Fa-f]"), _by_class(value, key, "token", 6))


_MAPS = {"email": _email, "token": _token, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """(kind, text): the kind of a match of ``ANY`` and its pseudonym; kind null and the text itself where invalid."""
    kind, fresh = None, None
    for name, pattern in PATTERNS.items():
        is_kind = value.rlike(f"^(?:{pattern})$")
        kind = F.when(is_kind, F.lit(name)) if kind is None else kind.when(is_kind, F.lit(name))
        fresh = F.when(is_kind, _MAPS[name](value, key)) if fresh is None else fresh.when(is_kind, _MAPS[name](value, key))
    return F.struct(F.when(fresh.isNotNull(), kind).alias("kind"), F.coalesce(fresh, value).alias("text"))


def working_key(key: str) -> str:
    """What the plan holds of a secret: a keyed digest, so that plans and event logs do not show the secret itself.

    Whoever reads the digest from a plan can undo the pseudonyms of that key but learns nothing of the secret or of the
    digests for other purposes; keep event logs as private as the key.
    """
    return hmac.new(key.encode(), b"format-preserving pseudonyms", "sha256").hexdigest()


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced, kinds): every row with its valid private values replaced.

    ``kinds`` counts replacements by kind (a map). Cards must pass the Luhn check and get a new check digit; addresses
    must have octets up to 255; dates must exist and lie in 1800 to 2199, those with
    a day over 12 after a slash are read month first; social security numbers must have an area, group and serial that exist; phone numbers need a country code, which
    stays; of e-mail addresses the local part changes; hexadecimal tokens need letters and digits. Other matches stay.

    One pass, no shuffle. A null text stays null with nothing replaced; an empty one stays empty. Repeated rows give
    repeated results, an empty table gives an empty one; other columns are ignored. A permutation may leave a value
    as it is, as rarely as its format has values.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    some = F.col("body").rlike(r"[0-9@]")
    rows = rows.withColumn("found", F.when(some, F.regexp_extract_all("body", F.lit(ANY), F.lit(0))))
    secret = working_key(key)
    rows = rows.withColumn("fresh", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(m, secret))))
    between = F.split("body", ANY, -1)
    glued = F.array_join(F.zip_with(between, "fresh", lambda p, f: F.concat(p, F.coalesce(f["text"], F.lit("")))), "")
    kinds = F.filter(F.transform("fresh", lambda f: f["kind"]), lambda k: k.isNotNull())
    rows = rows.withColumn("kinds", F.coalesce(kinds, F.array().cast("array<string>")))
    counted = F.map_from_entries(F.transform(F.array_sort(F.array_distinct("kinds")), lambda k: F.struct(k, F.size(F.filter("kinds", lambda x: x == k)))))
    return rows.select("doc_id", F.when(F.col("fresh").isNotNull(), glued).otherwise(F.col("body")).alias("text"),
                       F.size("kinds").cast("long").alias("n_replaced"), counted.alias("kinds"))
