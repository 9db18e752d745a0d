"""Format-preserving pseudonyms for personal data.

Numbers and dates that are valid (cards by their check digit, addresses by
their octets, dates by the calendar, phone numbers by their shape) and mail
addresses are replaced by values of the same format.  A keyed Feistel network
permutes each format's own domain: the value is split in two parts, and in each
round one part has a keyed hash of the other added to it, modulo the size of its
domain.  That is a permutation whatever the hash is, so equal values get equal
pseudonyms in all documents, different ones different pseudonyms, and the key's
holder can turn them back (``restore=True``).

* card (13 to 19 digits): the digits before the check digit, which is then set anew;
* iban (valid by its check digits): the digits after these, which are then set anew; letters stay;
* phone (``+`` and country code, or ten digits as ``(555) 123-4567`` or ``555-123-4567``): the digits after the country
  code, so that a number has one pseudonym however it is cut, and with ``+1`` or without;
* ssn (``123-45-6789``, of the numbers that may be given out): its place among these;
* ip: the 32 bits of the four octets;
* date (``yyyy-mm-dd``, also before a time): the day's number in the 146,097 days of 1800 to 2199 (other dates: unchanged);
* dmy (``dd/mm/yyyy``, also with points): the same, with the same pseudonym as that date's; where only ``mm/dd/yyyy`` is a
  date, year and month, and the day among 13 to 28 (later days stay);
* mail: the letters and digits before the ``@``, letter by letter; the domain stays.

Marks, spaces and letter case stay as they are.  Invalid values aren't personal
data and stay.  Only DataFrame functions are used; nothing is shuffled.

Edge cases: null texts stay null, empty ones empty; a text without ``@`` and
digits isn't searched; there is no limit on a text's length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, packed

ROUNDS = 8
#: The formats, in the order in which they are tried.
PATTERNS = {
    # one character at a time, since a repeated group of several would recurse once for each label of the domain
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?=[A-Za-z0-9-])(?:(?!\.\.)[A-Za-z0-9.-])*\.[A-Za-z]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![.(-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-]|\.\d))",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w.-])\d{4}-\d{2}-\d{2}(?:(?=T\d{2}:)|(?![\w-]))",
    "dmy": r"(?<![\w./-])(?:\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
#: Fixed value: country codes, of which none begins another.
_COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DAYS = (189, 773)  # 189 * 773 = 146,097 days in 400 years


def _noise(key: str, kind: str, round_: Column, half: Column, size: Column) -> Column:
    """A keyed number below ``size``."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), round_.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)


def _feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str, restore: bool) -> Column:
    """struct(a, b), permuted: odd rounds add to a, even ones to b (taken off again in reverse order)."""
    sign = F.lit(-1 if restore else 1)

    def step(s: Column, r: Column) -> Column:
        new_a = F.pmod(s["a"] + sign * _noise(key, kind, r, s["b"], size_a), size_a)
        new_b = F.pmod(s["b"] + sign * _noise(key, kind, r, s["a"], size_b), size_b)
        odd = r % 2 == 1
        return F.struct(F.when(odd, new_a).otherwise(s["a"]).alias("a"), F.when(odd, s["b"]).otherwise(new_b).alias("b"))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if restore else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _permuted_digits(digits: Column, key: str, kind: str, restore: bool) -> Column:
    """Digits, as two halves of up to 18 digits each."""
    n = F.length(digits)
    left = F.floor((n + 1) / 2).cast("int")
    part = lambda x: F.coalesce(x.try_cast("long"), F.lit(0))
    a, b = part(F.substring(digits, F.lit(1), left)), part(F.substring(digits, left + 1, n))
    size = lambda k: F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")
    out = _feistel(a, b, size(left), size(n - left), key, kind, restore)
    return _let(out, lambda s: F.concat(F.lpad(s["a"].cast("string"), left, F.lit("0")),
                                        F.when(n > left, F.lpad(s["b"].cast("string"), n - left, F.lit("0")))
                                        .otherwise("")))


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits whose last stands at an undoubled place."""
    n = F.length(digits)
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.split(digits, ""), lambda c, i: F.when(
        (n - i) % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d)


def _put_back(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda s, c: F.when(c.between("0", "9"), F.struct(
        F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
        F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
    return F.aggregate(F.split(value, ""), start, step, lambda s: s["out"])


def _card(value: Column, key: str, restore: bool) -> Column:
    def valid(digits: Column) -> Column:
        n = F.length(digits)
        body = _permuted_digits(F.substring(digits, F.lit(1), n - 1), key, "card", restore)
        new = _let(body, lambda x: F.concat(x, ((10 - _luhn(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_luhn(digits) % 10 == 0, _let(new, lambda x: _put_back(value, x)))

    return _let(_digits(value), valid)


def _phone(value: Column, key: str, restore: bool) -> Column:
    code = F.regexp_extract(value, _COUNTRY, 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    new = _let(_digits(rest), lambda d: F.when(F.length(d) >= 7, _permuted_digits(d, key, "phone", restore)))
    return _let(new, lambda d: F.when(d.isNotNull(), F.concat(code, _put_back(rest, d))))


def _mod97(text: Column) -> Column:
    """The number that letters (A = 10) and digits spell, modulo 97."""
    def step(m: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (m * 10 + c.try_cast("int")) % 97).otherwise((m * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(value: Column, key: str, restore: bool) -> Column:
    def valid(flat: Column) -> Column:
        country, body = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.length(flat))
        new = _let(_digits(body), lambda d: F.when(F.length(d) >= 2, _permuted_digits(d, key, "iban", restore)))
        check = lambda d: F.lpad((98 - _mod97(F.concat(_put_back(body, d), country, F.lit("00")))).cast("string"),
                                 2, "0")
        right = _mod97(F.concat(body, F.substring(flat, 1, 4))) == 1
        return F.when(right, _let(new, lambda d: F.when(d.isNotNull(), _put_back(value, F.concat(check(d), d)))))

    return _let(F.replace(value, F.lit(" "), F.lit("")), valid)


def _ssn(value: Column, key: str, restore: bool) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001."""
    part = lambda at, n: F.substring(value, at, n).try_cast("int")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    number = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1

    def told(s: Column) -> Column:
        nth = F.floor(s["a"] / 99)
        each = ((nth + F.when(nth >= 665, 2).otherwise(1), 3), (s["a"] % 99 + 1, 2), (s["b"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(v.cast("long").cast("string"), n, "0") for v, n in each])

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _let(_feistel(number, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", restore), told))


def _dmy(value: Column, key: str, restore: bool) -> Column:
    mark = F.substring(value, 3, 1)
    first, second, year = F.substring(value, 1, 2), F.substring(value, 4, 2), F.substring(value, 7, 4)
    iso = F.concat_ws("-", year, second, first)
    as_day = _let(_date(iso, key, restore), lambda d: F.concat(F.substring(d, 9, 2), mark, F.substring(d, 6, 2), mark,
                                                               F.substring(d, 1, 4)))
    month, day, since = first.try_cast("int"), second.try_cast("int"), year.try_cast("int") - 1800
    american = month.between(1, 12) & day.between(13, 28) & since.between(0, 399)
    moved = _feistel(since * 12 + month - 1, day - 13, F.lit(4800), F.lit(16), key, "mdy", restore)
    as_month = _let(moved, lambda s: F.concat(
        F.lpad((s["a"] % 12 + 1).cast("string"), 2, "0"), mark, (s["b"] + 13).cast("string"), mark,
        (F.floor(s["a"] / 12) + 1800).cast("long").cast("string")))
    return F.when(american, as_month).otherwise(as_day)


def _ip(value: Column, key: str, restore: bool) -> Column:
    def permuted(o: Column) -> Column:
        octet = lambda i: F.get(o, i)
        two = _feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), key, "ip", restore)
        low, high = (lambda x: x % 256), (lambda x: F.floor(x / 256))
        return _let(two, lambda s: F.concat_ws(".", *[f(s[h]).cast("long").cast("string")
                                                      for h in ("a", "b") for f in (high, low)]))

    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    return _let(octets, lambda o: F.when(F.forall(o, lambda x: x <= 255), permuted(o)))


def _date(value: Column, key: str, restore: bool) -> Column:
    first = F.lit("1800-01-01").cast("date")
    a, b = _DAYS

    def permuted(day: Column) -> Column:
        two = _feistel(F.floor(day / b), day % b, F.lit(a), F.lit(b), key, "date", restore)
        return _let(two, lambda s: F.date_add(first, (s["a"] * b + s["b"]).cast("int")).cast("string"))

    day = F.datediff(value.try_cast("date"), first)
    return _let(day, lambda d: F.when(d.between(0, a * b - 1), permuted(d)))


def _mail(value: Column, key: str, restore: bool) -> Column:
    """The local part's two halves; each letter or digit is moved inside its own alphabet by the other half's hash."""
    local = F.substring_index(value, "@", 1)
    rest = F.substring(value, F.length(local) + 1, F.length(value))

    def moved(half: Column, other: Column, r: Column) -> Column:
        digest = F.sha2(F.lower(F.array_join(other, "")), 256)  # so that a letter's work doesn't grow with the half

        def letter(c: Column, i: Column, text: Column) -> Column:
            by = _noise(key, "mail", F.concat_ws("-", r, i), text, F.lit(1 << 40)) * F.lit(-1 if restore else 1)
            within = lambda base, size: F.char((F.pmod(F.ascii(c) - base + by, F.lit(size)) + base))
            return (F.when(c.between("0", "9"), within(48, 10)).when(c.rlike("[a-z]"), within(97, 26))
                    .when(c.rlike("[A-Z]"), within(65, 26)).otherwise(c))

        return _let(digest, lambda text: F.transform(half, lambda c, i: letter(c, i, text)))

    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(F.when(odd, moved(s["a"], s["b"], r)).otherwise(s["a"]).alias("a"),
                        F.when(odd, s["b"]).otherwise(moved(s["b"], s["a"], r)).alias("b"))

    def permuted(chars: Column) -> Column:
        half = F.floor((F.size(chars) + 1) / 2).cast("int")
        start = F.struct(F.slice(chars, F.lit(1), half).alias("a"), F.slice(chars, half + 1, F.size(chars)).alias("b"))
        rounds = F.sequence(F.lit(4), F.lit(1), F.lit(-1)) if restore else F.sequence(F.lit(1), F.lit(4))
        return F.aggregate(rounds, start, step, lambda s: F.concat(F.array_join(s["a"], ""), F.array_join(s["b"], "")))

    return F.concat(_let(F.split(local, ""), permuted), rest)


_OF = {"mail": _mail, "iban": _iban, "phone": _phone, "ssn": _ssn, "date": _date, "dmy": _dmy, "ip": _ip, "card": _card}


def _kind(value: Column) -> Column:
    return reduce(lambda w, k: w.when(value.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)), list(PATTERNS)[1:],
                  F.when(value.rlike(f"^(?:{PATTERNS['mail']})$"), F.lit("mail")))


def _replaced(value: Column, key: str, restore: bool) -> Column:
    """struct(kind, new): new is null for values that aren't valid."""
    kind = _kind(value)
    pick = lambda k: reduce(lambda w, n: w.when(k == n, _OF[n](value, key, restore)), list(_OF)[1:],
                            F.when(k == "mail", _mail(value, key, restore)))
    return _let(kind, lambda k: F.struct(k.alias("kind"), value.alias("old"), pick(k).alias("new")))


def _rows(df: DataFrame, text_col: str, key: str, restore: bool) -> DataFrame:
    """(row, text, found): the packed row, the new text, and the values found."""
    rows = df.select(packed(df), col(text_col).cast("string").alias("t"))
    some = F.when(F.col("t").rlike("[0-9@]"), F.regexp_extract_all("t", F.lit(_ANY), 0))
    rows = rows.select("row", "t", some.alias("values"))
    rows = rows.select("row", "t", F.when(F.size("values") > 0, F.transform(
        "values", lambda v: _replaced(v, key, restore))).alias("found"))
    parts = F.split("t", _ANY, -1)
    text = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(
        F.get("found", i)["new"], F.get("found", i)["old"], F.lit("")))), "")
    return rows.select("row", F.when(F.col("found").isNull(), F.col("t")).otherwise(text).alias("text"),
                       F.filter("found", lambda x: x["new"].isNotNull()).alias("found"))


def pseudonyms(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
               restore: bool = False) -> DataFrame:
    """One row per row of ``df``: the id, how many values of each kind were replaced, and the new text."""
    count = lambda k: F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == k)), F.lit(0)).cast("long")
    return _rows(df, text_col, key, restore).select(
        F.col("row")[id_col].alias(id_col), *[F.when(F.col("found").isNull(), F.lit(0).cast("long")).otherwise(count(k))
                                              .alias(f"n_{k}") for k in PATTERNS], F.col("text").alias(text_col))


def linked_values(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kind, pseudonym): where each replaced value occurs; equal values have equal pseudonyms."""
    found = _rows(df, text_col, key, False).select(F.col("row")[id_col].alias(id_col), F.explode_outer("found").alias("x"))
    return found.where("x is not null").select(id_col, "x.kind", F.col("x.new").alias("pseudonym"))
