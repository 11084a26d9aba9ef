"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh

#: Candidates of each kind. A candidate becomes a pseudonym only if it is valid (check digit, ranges, calendar).
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
PHONE = r"(?<![0-9A-Za-z.+-])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])"
#: Whole numbers without marks, or groups of digits.
ABROAD = r"(?<![0-9A-Za-z+])\+[2-9](?:[0-9]{7,14}(?!\.[0-9])|[0-9]{0,6}(?:[ -]\(?[0-9]{1,9}\)?(?![0-9]|\.[0-9])){1,4})(?![0-9A-Za-z])"
#: Country codes of one and two digits; all others have three.
COUNTRY = r"^\+(7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})"
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z.-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?=[Tt][0-9]|(?![0-9A-Za-z-]|\.[0-9]))"
SSN = r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
ANY = f"{EMAIL}|{PHONE}|{ABROAD}|{IPV4}|{DATE}|{SSN}|{CARD}"

ROUNDS = 10
#: Days from 1900-01-01 to 2099-12-31: 17 x 4297.
DATE_LEFT, DATE_RIGHT = 17, 4297
#: Most applications of the permutation until a date is found on the same side of the 12th; each finds one in two or three of five cases.
DATE_STEPS = 100


def _feistel(left: Column, right: Column, lefts: Column, rights: Column, key: str, tag: Column) -> Column:
    """(a, b): a keyed permutation of all pairs with 0 <= a < lefts and 0 <= b < rights. Rounds add a keyed hash of one half to the other."""
    def mixed(half: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(now: Column, i: Column) -> Column:
        a, b = now["a"], now["b"]
        turned_a = F.struct(((a + mixed(b, i) % lefts) % lefts).alias("a"), b.alias("b"))
        turned_b = F.struct(a.alias("a"), ((b + mixed(a, i) % rights) % rights).alias("b"))
        return F.when(i % 2 == 0, turned_a).otherwise(turned_b)

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(radix: int, n: Column) -> Column:
    return F.aggregate(F.array_repeat(F.lit(radix).cast("long"), n.cast("int")), F.lit(1).cast("long"), lambda a, x: a * x)


def _number(symbols: Column, radix: int) -> Column:
    """Value of a string of digits, or of letters a to z, in its radix; 0 for an empty one."""
    if radix == 10:
        return F.concat(F.lit("0"), symbols).cast("long")
    chars = F.filter(F.split(symbols, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), lambda a, c: a * radix + (F.ascii(c) - 97).cast("long"))


def _symbols(value: Column, n: Column, radix: int) -> Column:
    if radix == 10:
        return F.when(n > 0, F.lpad(value.cast("string"), n, "0")).otherwise(F.lit(""))
    places = F.filter(F.sequence(n.cast("int") - 1, F.lit(-1)), lambda k: k >= 0)
    digits = F.transform(places, lambda k: F.char(F.floor(value / _power(radix, k)).cast("long") % radix + 97))
    return F.array_join(digits, "")


def _permuted(symbols: Column, radix: int, key: str, tag: Column, chunk: int = 18) -> Column:
    """A string of the same length over the same symbols, permuted in runs of up to `chunk`."""
    runs = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(symbols) / chunk).cast("int") - 1, F.lit(0)))

    def run(i: Column) -> Column:
        part = F.substr(symbols, i * chunk + 1, F.lit(chunk))
        n = F.length(part)
        left, right = F.floor(n / 2).cast("int"), n - F.floor(n / 2).cast("int")
        both = _feistel(_number(F.substr(part, F.lit(1), left), radix), _number(F.substr(part, left + 1, right), radix), _power(radix, left), _power(radix, right), key, F.concat_ws("|", tag, F.length(symbols).cast("string"), i.cast("string")))
        return F.aggregate(F.array(both), F.lit(""), lambda a, x: F.concat(a, _symbols(x["a"], left, radix), _symbols(x["b"], right, radix)))

    return F.array_join(F.transform(runs, run), "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, not wherever it occurs."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _refilled(found: Column, marks: str, symbols: Column) -> Column:
    """`found` with its characters of the class `marks` replaced in turn by `symbols`."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(now: Column, c: Column) -> Column:
        taken = F.struct(F.concat(now["s"], F.substr(symbols, now["i"], F.lit(1))).alias("s"), (now["i"] + 1).alias("i"))
        return F.when(c.rlike(marks), taken).otherwise(F.struct(F.concat(now["s"], c).alias("s"), now["i"].alias("i")))

    return F.aggregate(F.split(found, ""), start, step, lambda now: now["s"])


def _only(found: Column, marks: str) -> Column:
    return F.regexp_replace(found, f"[^{marks}]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule, from the right: digits at even places doubled, their digits added."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    each = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(2 * d - 9 * (d > 4)) for d in range(10)]), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(found: Column, key: str) -> Column:
    """First digit kept, check digit made right again."""
    def changed(digits: Column) -> Column:
        def filled(body: Column) -> Column:
            head = F.concat(F.substr(digits, F.lit(1), F.lit(1)), body)
            check = (10 - _luhn(F.concat(head, F.lit("0"))) % 10) % 10
            return _refilled(found, "[0-9]", F.concat(head, check.cast("string")))
        return F.when(_luhn(digits) % 10 == 0, _let(_permuted(F.substr(digits, F.lit(2), F.length(digits) - 2), 10, key, F.concat(F.lit("card"), F.substr(digits, F.lit(1), F.lit(1)))), filled)).otherwise(found)
    return _let(_only(found, "0-9"), changed)


def _ipv4(found: Column, key: str) -> Column:
    def changed(octets: Column) -> Column:
        at = [F.element_at(octets, i + 1).cast("long") for i in range(4)]
        valid = F.forall(octets, lambda o: (o.cast("int") <= 255) & ((F.length(o) == 1) | ~o.startswith("0")))
        both = _feistel(at[0] * 256 + at[1], at[2] * 256 + at[3], F.lit(65536), F.lit(65536), key, F.lit("ipv4"))
        joined = lambda x: F.concat_ws(".", *[(F.floor(x[h] / 256) if k == 0 else x[h] % 256).cast("string") for h in "ab" for k in (0, 1)])
        return F.when(valid, _let(both, joined)).otherwise(found)
    return _let(F.split(found, r"\."), changed)


def _phone(found: Column, key: str) -> Column:
    """Country code and layout kept; area and exchange each stay below 200, or within 200 to 999."""
    def changed(digits: Column) -> Column:
        part = lambda a, n: F.substr(digits, F.lit(a), F.lit(n)).cast("long")
        least = [F.when(part(a, 3) < 200, 0).otherwise(200).cast("long") for a in (1, 4)]
        many = [F.when(part(a, 3) < 200, 20000).otherwise(80000).cast("long") for a in (1, 4)]
        both = _feistel((part(1, 3) - least[0]) * 100 + part(7, 2), (part(4, 3) - least[1]) * 100 + part(9, 2), many[0], many[1], key, F.lit("phone"))
        shown = lambda x: F.concat(*[F.lpad(v.cast("string"), n, "0") for v, n in ((F.floor(x["a"] / 100) + least[0], 3), (F.floor(x["b"] / 100) + least[1], 3), (x["a"] % 100, 2), (x["b"] % 100, 2))])
        country = F.length(_only(found, "0-9")) == 11
        return _let(_let(both, shown), lambda new: _refilled(found, "[0-9]", F.when(country, F.concat(F.lit("1"), new)).otherwise(new)))
    return _let(F.right(_only(found, "0-9"), F.lit(10)), changed)


def _abroad(found: Column, key: str) -> Column:
    """8 to 15 digits; the country code is kept."""
    digits = _only(found, "0-9")
    head = F.regexp_extract(F.concat(F.lit("+"), digits), COUNTRY, 1)
    rest = F.substr(digits, F.length(head) + 1, F.lit(20))
    return F.when(F.length(digits).between(8, 15), _let(_permuted(rest, 10, key, F.concat(F.lit("abroad"), head)), lambda new: _refilled(found, "[0-9]", F.concat(head, new)))).otherwise(found)


def _ssn(found: Column, key: str) -> Column:
    area, group, serial = (F.substr(found, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    both = _feistel(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"))

    def shown(x: Column) -> Column:
        number = x["a"] + 1
        parts = ((number + F.when(number >= 666, 1).otherwise(0), 3), (F.floor(x["b"] / 9999) + 1, 2), (x["b"] % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in parts])
    return _let(both, shown)


def _date(found: Column, key: str) -> Column:
    """Days up to the 12th stay so, later ones too: what can be read month first, and what only day first, stays so in every format."""
    shapes = ("yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy")
    first_month = F.try_to_date(F.when(found.contains("/"), found), "MM/dd/yyyy").isNotNull()
    shape = F.when(found.contains("-"), shapes[0]).when(found.contains("."), shapes[1]).when(first_month, shapes[2]).otherwise(shapes[3])
    parsed = F.coalesce(*[F.when(shape == s, F.try_to_date(found, s)) for s in shapes])
    first = F.lit("1900-01-01").cast("date")
    day_of = lambda x: F.date_add(first, (x["a"] * DATE_RIGHT + x["b"]).cast("int"))

    def changed(date: Column) -> Column:
        days = F.date_diff(date, first).cast("long")
        start = F.struct(F.floor(days / DATE_RIGHT).cast("long").alias("a"), (days % DATE_RIGHT).alias("b"))

        def step(now: Column, i: Column) -> Column:
            there = (i > 0) & ((F.dayofmonth(day_of(now)) > 12) == (F.dayofmonth(date) > 12))
            return F.when(there, now).otherwise(_feistel(now["a"], now["b"], F.lit(DATE_LEFT), F.lit(DATE_RIGHT), key, F.lit("date")))

        walked = F.aggregate(F.sequence(F.lit(0), F.lit(DATE_STEPS)), start, step)
        return _let(walked, lambda x: F.coalesce(*[F.when(shape == s, F.date_format(day_of(x), s)) for s in shapes]))
    return F.when(parsed.isNotNull(), _let(parsed, changed)).otherwise(found)


def _email(found: Column, key: str) -> Column:
    """Letters stay letters and digits digits, case and marks as they are; the domain is kept."""
    local, domain = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
    tag = F.lower(domain)
    letters = _permuted(_only(F.lower(local), "a-z"), 26, key, F.concat(F.lit("email-a|"), tag))
    digits = _permuted(_only(local, "0-9"), 10, key, F.concat(F.lit("email-0|"), tag))
    lower = _let(letters, lambda a: _let(digits, lambda d: _refilled(_refilled(F.lower(local), "[a-z]", a), "[0-9]", d)))
    cased = lambda new: F.array_join(F.transform(F.filter(F.split(local, ""), lambda c: c != ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(new, i + 1, F.lit(1)))).otherwise(F.substr(new, i + 1, F.lit(1)))), "")
    return F.concat(_let(lower, cased), F.lit("@"), domain)


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one candidate, or the candidate itself if it is not valid."""
    whole = lambda pattern: found.rlike(f"^(?:{pattern})$")
    kinds = ((EMAIL, _email), (PHONE, _phone), (ABROAD, _abroad), (IPV4, _ipv4), (DATE, _date), (SSN, _ssn), (CARD, _card))
    chosen = F.when(whole(kinds[0][0]), kinds[0][1](found, key))
    for pattern, make in kinds[1:]:
        chosen = chosen.when(whole(pattern), make(found, key))
    return chosen.otherwise(found)


def pseudonymise(df: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """`df` with personal data in `text` replaced by pseudonyms of the same format; `count` names a column for their number.

    E-mail addresses, telephone numbers, IPv4 addresses, dates, social security numbers and card numbers that are valid
    are permuted by a Feistel network under `key` within all valid values of their format: equal values get equal
    pseudonyms in every document, different ones different pseudonyms, and whoever has the key can undo it. All other
    text stays as it is, byte for byte; a text without valid values is returned unchanged, null stays null with count
    0. Other columns pass through; no shuffle, no Python.
    """
    body = F.col(f"`{text}`")
    found = F.regexp_extract_all(body, F.lit(ANY), F.lit(0))
    new = F.transform(found, lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    kept = F.split(body, ANY, -1)
    rebuilt = _let(new, lambda pairs: F.struct(F.array_join(F.transform(kept, lambda p, i: F.concat(p, F.coalesce(F.get(pairs, i)["new"], F.lit("")))), "").alias("t"), F.size(F.filter(pairs, lambda p: p["old"] != p["new"])).alias("n")))
    likely = (body.contains("@") | body.rlike("[0-9]")) & body.rlike(ANY)
    changed = fresh("_changed", df.columns)
    done = df.withColumn(changed, F.when(likely, rebuilt))
    columns = [F.coalesce(F.col(changed)["t"], body).alias(text) if c == text else F.col(f"`{c}`") for c in df.columns if c != count]
    if count:
        columns.append(F.coalesce(F.col(changed)["n"], F.lit(0)).cast("long").alias(count))
    return done.select(*columns)
