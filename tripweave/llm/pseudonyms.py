"""Operator 5: format-preserving Feistel pseudonyms for personal numbers and dates, in native expressions only.

Values that pass their validation are permuted by a key within their own format
and stay valid there, so equal values get equal pseudonyms in every document:

* payment cards (13 to 19 digits, Luhn): all digits but the last are permuted,
  the check digit is computed anew; separators stay;
* IBANs (mod 97): letters and digits of the account part, new check digits;
* social security numbers, North American phone numbers, IPv4 addresses;
* dates (ISO, dotted, slashed; calendar-checked, 1900 to 2099);
* e-mail addresses: letters and digits of the local part, by character kind.

A value becomes an array of symbols, each with its radix.  The array is cut in
two; in alternating rounds one part is shifted, symbol by symbol and modulo the
radix, by a keyed hash of the other part.  Every round can be undone, so the
whole is a permutation of all values of that format.

Candidates are first looked for in their legal forms only (cards by their usual
groups, IBANs by their country's length).  A text where one fails validation, or
where a looser form is left, is looked at once more, region by region: every
place where a value may start is tried, from left to right, kind by kind, and
then every separator-bounded length of the loose forms, longest first, in what
is left.  So a failing candidate hides no value inside it or across its end.

Rules: null text stays null, empty text empty; candidates that fail validation
stay as they are; rows are worked on alone, so there is nothing to skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.llm.common import free_name, table

ROUNDS = 10
#: Kinds in the order in which they are tried, with their patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|(?:19|20)[0-9]{2}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
#: Account numbers' countries by the length of their IBANs.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_BEFORE, _AFTER = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"


def _grouped(country: str, n: int) -> str:
    tail = f" [A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return f"(?:{country})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}{tail})"


#: Legal forms of the kinds whose patterns are loose, as parts of those; cards in one run or in groups with one separator.
LEGAL = {
    "iban": _BEFORE + "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(_grouped(c, n) for n, c in _IBAN_LENGTHS.items()) + ")" + _AFTER,
    "card": _BEFORE + "(?:[0-9]{13,19}|" + "|".join(
        f"[0-9]{{4}}{sep}" + sep.join(f"[0-9]{{{n}}}" for n in groups)
        for sep in (" ", "-") for groups in ((4, 4, 4), (6, 5), (6, 4), (3, 3, 3))) + ")" + _AFTER,
}
STRICT = [LEGAL.get(kind, p) for kind, p in PATTERNS.items()]
#: Loose forms by length, longest first.
LOOSE = [
    _BEFORE + "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}" + _AFTER,
    *(f"{_BEFORE}[A-Z]{{2}}[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n}}} [A-Z0-9]{{1,4}}{_AFTER}" for n in range(7, 1, -1)),
    _BEFORE + "[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2}" + _AFTER,
    *(f"{_BEFORE}[0-9](?:[ -]?[0-9]){{{n}}}{_AFTER}" for n in range(18, 11, -1)),
]


def _either(patterns) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


ANY, ANY_STRICT, ANY_LOOSE = _either(PATTERNS.values()), _either(STRICT), _either([PATTERNS["iban"], PATTERNS["card"]])
#: Stretches that no value crosses: values' characters, and single blanks where an IBAN, a card or a phone number may have one.
REGION = r"[A-Za-z0-9._%+@()/-]++(?:(?<=[A-Z0-9)]) (?=[A-Z0-9(])[A-Za-z0-9._%+@()/-]++)*+"
#: Characters that a value other than an e-mail address may take up, and more.
_REACH = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _ints(text: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("int"))


def feistel(symbols: Column, radices: Column, key: str, kind: str) -> Column:
    """A keyed permutation of arrays of symbols 0..radix-1."""
    n = F.size(symbols)
    half = F.greatest(F.floor(n / 2).cast("int"), F.lit(0))
    halves = F.struct(F.slice(symbols, 1, half).alias("a"), F.slice(symbols, half + 1, n).alias("b"))

    def shifted(part, first, other, turn):
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), turn, F.array_join(F.transform(other, lambda x: x.cast("string")), ","))
        # six hexadecimal digits of hash i / 10 for each symbol
        return _let(seed, lambda s: F.transform(part, lambda x, i: (
            (x + F.conv(F.substring(F.sha2(F.concat_ws("|", s, F.floor(i / 10)).cast("binary"), 256), (i % 10) * 6 + 1, F.lit(6)), 16, 10).cast("long"))
            % F.get(radices, first + i)).cast("int")))

    def step(acc, turn):
        return F.when(turn % 2 == 0, F.struct(shifted(acc["a"], F.lit(0), acc["b"], turn).alias("a"), acc["b"].alias("b"))).otherwise(
            F.struct(acc["a"].alias("a"), shifted(acc["b"], half, acc["a"], turn).alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, step, lambda acc: F.concat(acc["a"], acc["b"]))


def _refilled(shape: Column, pattern: str, fill: Column) -> Column:
    """``shape`` whose characters of ``pattern`` are replaced, in order, by the strings of ``fill``."""
    start = F.struct(F.lit(0).alias("k"), F.lit("").alias("out"))
    return F.aggregate(_chars(shape), start, lambda acc, c: F.when(
        c.rlike(pattern), F.struct((acc["k"] + 1).alias("k"), F.concat(acc["out"], F.get(fill, acc["k"])).alias("out")))
        .otherwise(F.struct(acc["k"].alias("k"), F.concat(acc["out"], c).alias("out"))), lambda acc: acc["out"])


def _texts(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("string"))


def _ten(a: Column) -> Column:
    return F.transform(a, lambda _: F.lit(10))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits, the last counting once."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: str) -> Column:
    def body(d):
        most = F.slice(d, 1, F.size(d) - 1)
        return _let(feistel(most, _ten(most), key, "card"), lambda p: _refilled(m, "[0-9]", _texts(F.concat(
            p, F.array(((10 - luhn_sum(F.concat(p, F.array(F.lit(0)))) % 10) % 10).cast("int"))))))
    return _let(_ints(m), lambda d: F.when((luhn_sum(d) % 10 == 0) & (F.array_max(d) > 0), body(d)))


def _letters_and_digits(m: Column, key: str, kind: str) -> Column:
    """Each letter becomes a letter of its case, each digit a digit; other characters stay."""
    own = F.regexp_replace(m, "[^A-Za-z0-9]", "")

    def body(cs):
        symbols = F.transform(cs, lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.instr(F.lit(_UPPER), F.upper(c)) - 1))
        radices = F.transform(cs, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26))
        return _let(feistel(symbols, radices, key, kind), lambda p: _refilled(m, "[A-Za-z0-9]", F.transform(p, lambda x, i: F.when(
            F.get(radices, i) == 10, x.cast("string")).when(F.get(cs, i).rlike("[a-z]"), F.lower(F.substring(F.lit(_UPPER), x + 1, F.lit(1))))
            .otherwise(F.substring(F.lit(_UPPER), x + 1, F.lit(1))))))
    return _let(_chars(own), body)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_letters_and_digits(local, key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _mod97(text: Column) -> Column:
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.instr(F.lit(_UPPER), c) + 9) % 97))


def _iban(m: Column, key: str) -> Column:
    def body(bare):
        country, account = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.char_length(bare))
        new = _let(_letters_and_digits(account, key, "iban"), lambda a: F.concat(
            country, F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a))
        valid = _mod97(F.concat(account, F.substring(bare, 1, 4))) == 1
        return F.when(valid, _let(new, lambda v: _refilled(m, "[A-Z0-9]", _chars(v))))
    return _let(F.replace(m, F.lit(" "), F.lit("")), body)


def _numbers(m: Column, key: str, kind: str, least: list[int], count: list[int]) -> Column:
    """Fields of digits as symbols of ``count`` values from ``least`` on; fields keep their width."""
    fields = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))

    def body(v):
        symbols = F.array(*[F.get(v, F.lit(i)) - a for i, a in enumerate(least)])
        ok = F.lit(True)
        for i, (a, n) in enumerate(zip(least, count)):
            ok = ok & F.get(v, F.lit(i)).between(a, a + n - 1)
        radices = F.array(*map(F.lit, count))
        return F.when(ok, feistel(symbols, radices, key, kind))
    return _let(F.transform(fields, lambda x: x.cast("int")), body)


def _ip(m: Column, key: str) -> Column:
    def out(p):
        return F.concat_ws(".", *[(F.get(p, F.lit(i)) + a).cast("string") for i, a in enumerate((1, 0, 0, 0))])
    return _let(_numbers(m, key, "ip", [1, 0, 0, 0], [223, 256, 256, 256]), lambda p: F.when(p.isNotNull(), out(p)))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001; areas after 666 move up by one."""
    area = F.substring(m, 1, 3).cast("int")
    dense = F.concat(F.lpad(F.when(area > 666, area - 1).otherwise(area).cast("string"), 3, "0"), F.substring(m, F.lit(4), F.lit(8)))

    def out(p):
        a = F.get(p, F.lit(0)) + 1
        return F.concat_ws("-", F.lpad(F.when(a >= 666, a + 1).otherwise(a).cast("string"), 3, "0"),
                           F.lpad((F.get(p, F.lit(1)) + 1).cast("string"), 2, "0"), F.lpad((F.get(p, F.lit(2)) + 1).cast("string"), 4, "0"))
    return F.when(area != 666, _let(_numbers(dense, key, "ssn", [1, 1, 1], [898, 99, 9999]), lambda p: F.when(p.isNotNull(), out(p))))


def _phone(m: Column, key: str) -> Column:
    """The ten digits; a leading country code stays."""
    def body(d):
        own = F.slice(d, F.size(d) - 9, 10)
        low = F.transform(own, lambda _, i: F.when((i == 0) | (i == 3), 2).otherwise(0))
        new = feistel(F.transform(own, lambda x, i: x - F.get(low, i)), F.transform(low, lambda x: 10 - x), key, "phone")
        return _let(new, lambda p: _refilled(m, "[0-9]", _texts(F.concat(F.slice(d, 1, F.size(d) - 10), F.transform(p, lambda x, i: x + F.get(low, i))))))
    return _let(_ints(m), body)


#: Days from 1900-01-01 to 2099-12-31 are 17 * 4297.
_FIRST, _DAYS = "1900-01-01", (17, 4297)


def _date(m: Column, key: str) -> Column:
    y1 = m.rlike("^[0-9]{4}")
    iso = F.when(y1, F.translate(m, "/", "-")).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    month_first = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))

    def moved(day):
        number = F.datediff(day, F.lit(_FIRST).cast("date"))
        p = feistel(F.array(F.floor(number / _DAYS[1]).cast("int"), (number % _DAYS[1]).cast("int")), F.array(*map(F.lit, _DAYS)), key, "date")
        return _let(p, lambda x: F.date_add(F.lit(_FIRST).cast("date"), F.get(x, F.lit(0)) * _DAYS[1] + F.get(x, F.lit(1))))

    slashed = F.contains(m, F.lit("/"))
    written = lambda n: F.when(
        y1, F.when(slashed, F.date_format(n, "yyyy/MM/dd")).otherwise(F.date_format(n, "yyyy-MM-dd"))).otherwise(
        F.when(slashed, F.date_format(n, "dd/MM/yyyy")).otherwise(F.date_format(n, "dd.MM.yyyy")))
    day_first = _let(F.try_to_date(iso, "yyyy-MM-dd"), lambda d: F.when(d.isNotNull(), _let(moved(d), written)))
    # slashed with the month first: only if it is no date with the day first, and only onto such
    v = _numbers(month_first, key, "date-us", [1900, 1, 13], [200, 12, 16])
    us = _let(v, lambda p: F.when(p.isNotNull(), F.concat_ws(
        "/", F.lpad((F.get(p, F.lit(1)) + 1).cast("string"), 2, "0"), (F.get(p, F.lit(2)) + 13).cast("string"), (F.get(p, F.lit(0)) + 1900).cast("string"))))
    late = _let(_numbers(F.substring(m, 7, 4), key, "date-year", [1900], [200]), lambda p: F.concat(F.substring(m, 1, 6), (F.get(p, F.lit(0)) + 1900).cast("string")))
    valid_us = F.try_to_date(month_first, "yyyy-MM-dd").isNotNull()
    return F.coalesce(day_first, F.when((F.substring(m, 3, 1) == "/") & valid_us, F.coalesce(us, F.when(~F.substring(m, 1, 5).eqNullSafe("02/29"), late))))


_MAKERS = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "phone": _phone, "ip": _ip, "card": _card}


def pseudonym(m: Column, key: str, kinds=tuple(PATTERNS)) -> Column:
    """(kind, value): the kind's number (of ``kinds``) and pseudonym of a candidate; null value if it is none."""
    out = F.lit(None).cast("string")
    number = F.lit(None).cast("int")
    for i, (kind, pattern) in reversed(list(enumerate(PATTERNS.items()))):
        if kind not in kinds:
            continue
        bare = "^(?:" + pattern + ")$"
        out = F.when(m.rlike(bare), _MAKERS[kind](m, key)).otherwise(out)
        number = F.when(m.rlike(bare), F.lit(i)).otherwise(number)
    return F.struct(number.alias("kind"), out.alias("value"))


_SEGMENT = "struct<text:string,kind:int>"
_SEGMENTS = f"array<{_SEGMENT}>"


def _segment(text: Column, kind: Column | None = None) -> Column:
    return F.struct(text.alias("text"), (F.lit(None) if kind is None else kind).cast("int").alias("kind")).cast(_SEGMENT)


def _scanned(region: Column, patterns: list[str], starts: str, key: str, kinds=tuple(PATTERNS)) -> Column:
    """Segments of ``region``: at each place where ``starts`` matches the first of ``patterns`` that is a valid value counts."""
    none = F.lit(None).cast("struct<old:string,kind:int,value:string>")
    reach = F.when(F.contains(region, F.lit("@")), F.char_length(region)).otherwise(_REACH)

    def value_at(s):
        # the character before takes part in the patterns' look-behind
        near = F.concat(F.when(s > 0, F.substring(region, s, F.lit(1))).otherwise("\n"), F.substring(region, s + 1, reach))
        olds = _let(near, lambda x: F.array(*[F.regexp_extract(x, rf"^[\s\S]({p})", 1) for p in patterns]))

        def tried(acc, m):
            made = _let(pseudonym(m, key, kinds), lambda v: F.when(v["value"].isNotNull(), F.struct(m.alias("old"), v["kind"].alias("kind"), v["value"].alias("value"))))
            return F.coalesce(acc, F.when(m != "", made))
        return F.aggregate(olds, none, tried)

    def step(acc, piece):
        s = acc["pos"]

        def moved(v):
            gap = F.substring(region, acc["at"] + 1, s - acc["at"])
            return F.struct((s + F.char_length(piece)).alias("pos"), F.when(v.isNotNull(), s + F.char_length(v["old"])).otherwise(acc["at"]).alias("at"),
                            F.when(v.isNotNull(), F.concat(acc["out"], F.array(_segment(gap), _segment(v["value"], v["kind"])))).otherwise(acc["out"]).alias("out"))
        return _let(F.when(s >= acc["at"], value_at(s)), moved)

    start = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("at"), F.array().cast(_SEGMENTS).alias("out"))
    return F.aggregate(F.split(region, f"(?={starts})", -1), start, step, lambda acc: F.concat(
        acc["out"], F.array(_segment(F.substring(region, acc["at"] + 1, F.char_length(region))))))


def _searched(text: Column, key: str) -> Column:
    """Segments of a text, every start and length tried."""
    def of_region(region):
        legal = _scanned(region, STRICT, ANY_STRICT, key)
        return F.flatten(F.transform(legal, lambda s: F.when(
            s["kind"].isNull() & s["text"].rlike(ANY_LOOSE), _scanned(s["text"], LOOSE, ANY_LOOSE, key, tuple(LEGAL))).otherwise(F.array(s))))

    found = F.transform(F.regexp_extract_all(text, F.lit(REGION), F.lit(0)), lambda r: F.when(
        r.rlike("[0-9@]") & r.rlike(ANY), of_region(r)).otherwise(F.array(_segment(r))))
    return _let(found, lambda rs: F.flatten(F.transform(F.split(text, REGION, -1), lambda g, i: F.concat(
        F.array(_segment(g)), F.coalesce(F.get(rs, i), F.array().cast(_SEGMENTS))))))


def pseudonymise(df: DataFrame, key: str, text: str = "text", found: str = "found") -> DataFrame:
    """``df`` with personal values in ``text`` replaced; ``found``: array of the replaced values' kinds, by number."""
    t = F.col(text)
    hit = t.rlike("[0-9@]") & t.rlike(ANY)
    spot, gaps, parts = free_name(df, "_values"), free_name(df, "_gaps"), free_name(df, "_parts")
    values = F.transform(F.regexp_extract_all(t, F.lit(ANY_STRICT), F.lit(0)), lambda m: pseudonym(m, key))
    cut = df.withColumn(spot, F.when(hit, values)).withColumn(gaps, F.when(hit, F.split(t, ANY_STRICT, -1)))
    again = F.exists(F.col(spot), lambda v: v["value"].isNull()) | F.exists(F.col(gaps), lambda g: g.rlike(ANY_LOOSE))
    once = F.flatten(F.transform(F.col(gaps), lambda g, i: F.when(i < F.size(spot), F.array(
        _segment(g), _segment(F.get(F.col(spot), i)["value"], F.get(F.col(spot), i)["kind"]))).otherwise(F.array(_segment(g)))))
    cut = cut.withColumn(parts, F.when(hit, F.when(again, _searched(t, key)).otherwise(once)))
    new = F.array_join(F.transform(F.col(parts), lambda s: s["text"]), "")
    kinds = F.transform(F.filter(F.col(parts), lambda s: s["kind"].isNotNull()), lambda s: s["kind"])
    return (cut.withColumn(found, F.coalesce(kinds, F.array().cast("array<int>")))
            .withColumn(text, F.when(F.col(parts).isNotNull(), new).otherwise(t)).drop(spot, gaps, parts))


def op5_pseudonyms(spark: SparkSession, sf_dir: str, key: str = "rotate-me") -> DataFrame:
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    counts = [F.size(F.filter("found", lambda k, i=i: k == i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(PATTERNS)]
    return out.select("doc_id", "text", *counts)
