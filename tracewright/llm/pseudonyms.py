"""Format-preserving pseudonyms for personal data, by DataFrame functions only.

Validated numbers (cards, phones, social security and bank account numbers, addresses of the internet protocol) and
dates are permuted within their own format by a keyed Feistel network over two residue rings: every round adds a
keyed hash of one half to the other half, modulo the size of its ring. That is a bijection for any sizes, so
equal values stay equal in all documents, different ones different, and check digits are computed anew.
Mail addresses and secrets have no numeric format; they become keyed hashes, which link in the same way.
"""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
#: The key is taken from this setting of the session. Whoever knows the key can undo the pseudonyms, so the public one
#: below, which stands in where none is set, is for tests and demonstrations only.
KEY_SETTING = "spark.tracewright.pseudonymKey"
KEY = "pseudonym-key"

#: Length of an account number by country; what follows one is no part of it.
ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


_KNOWN = "|".join(c for names in ACCOUNTS.values() for c in names.split())


def _accounts() -> str:
    """What may be an account: of the known countries by their lengths, of other countries of any length."""
    by_length = []
    for length, names in ACCOUNTS.items():
        groups, rest = divmod(length - 4, 4)
        by_length.append(rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    return rf"(?:{'|'.join(by_length)}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)\b"


#: Every place where an account or a card may begin, with what it may be; places may lie within one another.
ACCOUNT = rf"\b(?=({_accounts()}))"
CARD = r"(?<![0-9])(?=((?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{5})(?![0-9])))"
#: What is looked for, in this order; kind, pattern. Runs without a bound are possessive and entered once (a local part
#: begins where no character of one is before it, or where the last match ended), so they are linear and not recursive.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("iban", ""),  # the accounts of the text whose check digits hold: accounts_in()
    ("key", r"\bAKIA[0-9A-Z]{16}\b"),
    ("secret", r"(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]\s*[\"']?[A-Za-z0-9_+/-]{8,}"),
    ("hex", r"\b(?:[0-9a-f]{32,}|[0-9A-F]{32,})\b"),
    ("ip", r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    ("date", r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\1[0-9]{4})(?![0-9]|[./-][0-9])"),
    ("phone", r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}(?![0-9]|[.-][0-9])|(?<![0-9.-])1([ .-])[0-9]{3}\2[0-9]{3}\2[0-9]{4}(?![0-9]|[.-][0-9])|(?<![0-9.-])1[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9]|[.-][0-9])|(?<![0-9.-])[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9]|[.-][0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"),
    ("card", ""),  # likewise: cards_in()
)
#: Days are permuted among those of 1900-01-01 to 2099-12-31 (73,049, which is 17 times 4,297), all others of the years
#: 1 to 9999 among themselves (3,579,010, which is 10 times 357,901).
DAYS, OTHER_DAYS = (17, 4297), (10, 357_901)


def _any(found: dict[str, Column]) -> Column:
    """One alternation of all patterns; of kinds without a pattern, the numbers found. References to groups count from the
    first pattern on."""
    out: list[Column] = []
    groups = 0
    for kind, pattern in PATTERNS:
        if not pattern:
            no = "[A-Za-z0-9]" if kind == "iban" else "[0-9]"
            out.append(F.when(F.size(found[kind]) > 0, F.concat(F.lit(f"(?<!{no})(?:"), F.array_join(found[kind], "|"), F.lit(f")(?!{no})"))))
            continue
        out.append(F.lit("(?:" + re.sub(r"\\([1-9])", lambda m: f"\\{int(m[1]) + groups}", pattern) + ")"))
        groups += re.compile(pattern.replace(r"\G", "^")).groups
    return F.concat_ws("|", *out)


def _longest_first(found: Column) -> Column:
    order = F.array_sort(F.transform(F.array_distinct(F.array_compact(found)), lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x"))))
    return F.transform(order, lambda s: s["x"])


def cards_in(text: Column) -> Column:
    """The distinct card numbers of a text whose check digit holds, the longest first; digits before or after one that do
    not belong to it leave it as it is."""
    good = lambda d: luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d), F.lit(1))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(CARD), F.lit(1)))
    return _longest_first(F.filter(found, lambda m: _let(_digits(m), good)))


def accounts_in(text: Column) -> Column:
    """The distinct accounts of a text whose check digits hold, the longest first.

    Of a known country an account has its length; of another one it ends at the last space or end where the check digits
    hold. What only looks like an account is none, and leaves the numbers in it to the other patterns.
    """

    def account(m: Column) -> Column:
        plain = lambda i: F.regexp_replace(F.substr(m, F.lit(1), i), " ", "")
        known = m.rlike(f"^(?:{_KNOWN})")
        ends = F.filter(F.sequence(F.length(m), F.lit(12), F.lit(-1)), lambda i: F.when(known, i == F.length(m)).otherwise(F.substr(m, i + 1, F.lit(1)).isin("", " ")) & ~F.substr(m, i, F.lit(1)).isin(" ") & (_mod97(plain(i)) == 1))
        return _let(F.get(ends, F.lit(0)), lambda end: F.substr(m, F.lit(1), end))

    found = F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(ACCOUNT), F.lit(1))), account)
    return _longest_first(found)


def _keyed(key: str, tag: str, *values: Column) -> Column:
    """60 bits of a keyed hash as a non-negative long."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), *(v.cast("string") for v in values)), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tag: str, rounds: int = ROUNDS) -> Column:
    """struct<a, b>: the keyed permutation of (a, b) in the rings of size_a and size_b (each below 10 ** 16)."""

    def step(s: Column, r: Column) -> Column:
        even = F.struct(((s["a"] + _keyed(key, tag, size_a, size_b, r, s["b"])) % size_a).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + _keyed(key, tag, size_a, size_b, r, s["a"])) % size_b).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _power10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, tag: str) -> Column:
    """A digit string of up to 30 digits, permuted among those of its length."""
    u = F.floor(F.length(digits) / 2).cast("int")
    v = F.length(digits) - u
    a = F.when(u > 0, F.substr(digits, F.lit(1), u)).otherwise(F.lit("0")).cast("long")
    b = F.substr(digits, u + 1, v).cast("long")
    out = feistel(a, b, _power10(u), _power10(v), key, tag)
    return _let(out, lambda s: F.concat(F.when(u > 0, F.lpad(s["a"].cast("string"), u, "0")).otherwise(F.lit("")), F.lpad(s["b"].cast("string"), v, "0")))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refilled(m: Column, digits: Column) -> Column:
    """m with its digits replaced, in order, by those of `digits`."""
    at = lambda i: F.substr(m, i, F.lit(1))
    rank = lambda i: F.length(_digits(F.substr(m, F.lit(1), i)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(at(i).rlike("[0-9]"), F.substr(digits, rank(i), F.lit(1))).otherwise(at(i))), "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows a string of digits."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _card(m: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        n = F.length(d)
        valid = luhn_digit(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1))
        middle = permuted_digits(F.substr(d, F.lit(2), n - 2), key, "card")
        payload = F.concat(F.substr(d, F.lit(1), F.lit(1)), middle)
        return F.when(valid, _let(payload, lambda p: _refilled(m, F.concat(p, luhn_digit(p)))))

    return _let(_digits(m), made)


def _phone(m: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        n = F.least(F.length(d), F.lit(10))
        kept = F.length(d) - n
        return F.when(F.length(d).between(7, 15), _refilled(m, F.concat(F.substr(d, F.lit(1), kept), permuted_digits(F.substr(d, kept + 1, n), key, "phone"))))

    return _let(_digits(m), made)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def shown(s: Column) -> Column:
        place = F.floor(s["a"] / 99).cast("int")
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        return F.concat_ws("-", *(F.lpad(x.cast("string"), n, "0") for x, n in ((area, 3), (s["a"] % 99 + 1, 2), (s["b"] + 1, 4))))

    return F.when(valid, _let(out, shown))


def _ip(m: Column, key: str) -> Column:
    octet = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    valid = (octet[0] < 256) & (octet[1] < 256) & (octet[2] < 256) & (octet[3] < 256)
    out = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536), F.lit(65536), key, "ip")
    half = lambda x: [F.floor(x / 256).cast("int").cast("string"), (x % 256).cast("string")]
    return F.when(valid, _let(out, lambda s: F.concat_ws(".", *half(s["a"]), *half(s["b"]))))


def _date(m: Column, key: str) -> Column:
    """Year first, or month first with slashes and day first otherwise; the other order where only that is a date."""
    iso = m.contains("-")
    x, y, z = (F.regexp_extract(m, "^([0-9]+)[^0-9]([0-9]+)[^0-9]([0-9]+)$", i) for i in (1, 2, 3))
    of = lambda year, month, day: F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    month_first, day_first = of(z, x, y), of(z, y, x)
    us = F.when(m.contains("/"), month_first.isNotNull()).otherwise(day_first.isNull())
    when = F.when(iso, of(x, y, z)).when(us, month_first).otherwise(day_first)

    def made(d: Column) -> Column:
        day0, span = F.lit("1900-01-01").cast("date"), DAYS[0] * DAYS[1]
        n = F.datediff(d, day0)
        inner = n.between(0, span - 1)
        years = F.when(n < 0, F.datediff(d, F.lit("0001-01-01").cast("date"))).otherwise(n - span + F.datediff(day0, F.lit("0001-01-01").cast("date")))
        place = F.when(inner, n).otherwise(years)
        size_a, size_b = (F.when(inner, F.lit(x)).otherwise(F.lit(y)) for x, y in zip(DAYS, OTHER_DAYS, strict=True))
        out = feistel(F.floor(place / size_b), place % size_b, size_a, size_b, key, "date")
        early = F.datediff(day0, F.lit("0001-01-01").cast("date"))
        back = lambda p: F.when(inner, p).when(p < early, p - early).otherwise(p - early + span)
        new = F.date_add(day0, _let(out, lambda s: back(s["a"] * size_b + s["b"])).cast("int"))
        wide = F.length(m) == 10

        def shown(t: Column) -> Column:
            two = lambda v: F.when(wide, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
            sep = F.when(m.contains("/"), F.lit("/")).otherwise(F.lit("."))
            first, second = F.when(us, F.month(t)).otherwise(F.day(t)), F.when(us, F.day(t)).otherwise(F.month(t))
            return F.when(iso, F.date_format(t, "yyyy-MM-dd")).otherwise(F.concat(two(first), sep, two(second), sep, F.lpad(F.year(t).cast("string"), 4, "0")))

        return F.when(F.year(d) >= 1, _let(new, shown))

    return _let(when, made)


def _mod97(account: Column) -> Column:
    """Remainder of an account number, country and check digits moved to its end, letters as 10 to 35."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(total: Column, i: Column) -> Column:
        c = F.substr(moved, i, F.lit(1))
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (total * 10 + c.try_cast("int")) % 97).otherwise((total * 100 + letter) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    def made(m: Column) -> Column:
        a = F.regexp_replace(m, " ", "")
        body = F.substr(a, F.lit(5))
        new = _refilled(body, permuted_digits(_digits(body), key, "iban"))

        def checked(b: Column) -> Column:
            check = 98 - _mod97(F.concat(F.substr(a, F.lit(1), F.lit(2)), F.lit("00"), b))
            whole = F.concat(F.substr(a, F.lit(1), F.lit(2)), F.lpad(check.cast("string"), 2, "0"), b)
            spaced = F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(F.substr(m, i, F.lit(1)) == " ", F.lit(" ")).otherwise(F.substr(whole, F.length(F.regexp_replace(F.substr(m, F.lit(1), i), " ", "")), F.lit(1))))
            return F.array_join(spaced, "")

        return F.when(_digits(body).rlike("^[0-9]{1,30}$"), _let(new, checked))

    return made(m)


def _hashed(value: Column, key: str, tag: str, n: Column) -> Column:
    """n hex digits (up to 128, then repeated) that depend on the key and the value alone."""
    one = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), value), 256)
    two = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), F.lit("2"), value), 256)
    return F.substr(F.repeat(F.concat(one, two), F.ceil(n / 128).cast("int")), F.lit(1), n)


def pseudonym(m: Column, numbers: dict[str, Column], key: str = KEY) -> Column:
    """struct<kind, value> for a match of the patterns; value is null where the match is not valid."""
    value_of = F.regexp_extract(m, "([A-Za-z0-9_+/-]+)$", 1)
    email = F.concat(F.lit("u"), _hashed(F.lower(m), key, "email", F.lit(12)), F.lit("@"), F.substr(_hashed(F.lower(F.split_part(m, F.lit("@"), F.lit(2))), key, "domain", F.lit(8)), F.lit(1), F.lit(8)), F.lit(".invalid"))
    upper_hex = F.when(m.rlike("[A-F]"), F.upper(_hashed(F.lower(m), key, "hex", F.length(m)))).otherwise(_hashed(F.lower(m), key, "hex", F.length(m)))
    made = {
        "email": email, "iban": _iban(m, key), "key": F.concat(F.lit("AKIA"), F.upper(_hashed(m, key, "key", F.lit(16)))),
        "secret": F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value_of)), _hashed(value_of, key, "secret", F.length(value_of))),
        "hex": upper_hex, "ip": _ip(m, key), "date": _date(m, key), "phone": _phone(m, key), "ssn": _ssn(m, key), "card": _card(m, key),
    }
    out: Column | None = None
    for kind, pattern in PATTERNS:
        fits = m.rlike(f"^(?:{pattern})$") if pattern else F.array_contains(numbers[kind], m)
        found = F.struct(F.lit(kind).alias("kind"), made[kind].alias("value"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def pseudonymised(text: Column, key: str = KEY) -> Column:
    """struct<text, found: array<struct<kind, value>>>; found holds the matches in order, value null if kept."""

    def replaced(given: Column) -> Column:
        numbers = {"iban": given["iban"], "card": given["card"]}
        pattern = _any(numbers)
        matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.struct(m.alias("old"), pseudonym(m, numbers, key).alias("new")))
        gaps = F.split(text, pattern, -1)

        def joined(found: Column) -> Column:
            pieces = F.zip_with(gaps, found, lambda gap, x: F.concat(gap, F.coalesce(x["new"]["value"], x["old"], F.lit(""))))
            return F.struct(F.array_join(pieces, "").alias("text"), F.transform(found, lambda x: x["new"]).alias("found"))

        return _let(matches, joined)

    nothing = F.struct(text.alias("text"), F.array().cast("array<struct<kind: string, value: string>>").alias("found"))
    return F.when(text.rlike("[0-9@=:]"), _let(F.struct(accounts_in(text).alias("iban"), cards_in(text).alias("card")), replaced)).otherwise(nothing)


def key_of(spark: SparkSession) -> str:
    """The session's key, or the public one with a warning."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms use a public key and can be undone", stacklevel=2)
    return key or KEY


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with text replaced, other columns as they are, whatever their names.

    Null stays null, empty stays empty; texts of any length are read whole, in time linear in their length. Rows are
    independent: repeated rows and rows with a null doc_id are replaced like any other, and an empty table stays empty.
    """
    return docs.withColumn("text", pseudonymised(F.col("text"), key)["text"])


def pseudonymise_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text, n_replaced, kinds (distinct kinds that were replaced, ascending, joined by commas) of each row.

    Null and empty texts stay as they are, with 0 and no kinds. Rows with a null or repeated doc_id give a row each; empty
    docs give none; other columns are ignored.
    """
    out = docs.select("doc_id", pseudonymised(F.col("text"), key).alias("p"))
    replaced = F.filter(F.coalesce("p.found", F.array().cast("array<struct<kind: string, value: string>>")), lambda x: x["value"].isNotNull())
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(replaced, lambda x: x["kind"]))), ",")
    return out.select("doc_id", "p.text", F.size(replaced).alias("n_replaced"), kinds.alias("kinds"))
