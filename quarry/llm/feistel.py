"""Format-preserving pseudonyms by a keyed Feistel network (operator 3), in SQL
functions only.

Personal values found in a text are replaced by values of the same format.  A
value is taken apart into symbols, each from a small range (a digit, a letter, an
octet, a day number); an alternating Feistel network over the two halves of the
symbols, with SHA-512 over key, kind, round and the other half as its round
function, permutes all values of a format.  Equal values therefore get equal
pseudonyms in all documents, different values different ones, and whoever has
the key can invert them.

Validated: card numbers of 13 to 19 digits by their check digit (kept valid), IPv4
octets, phone numbers by plan, social security numbers by range, dates by the calendar.
Sixteen-digit numbers that fail the check digit are account numbers and keep
failing it by as much; those of other lengths are no cards and stay.  Foreign phone
numbers have 8 to 15 digits after a plus sign, the first two of which stay.  Mail
addresses of any length, IPv6 addresses and secrets (access keys, passwords, tokens) are
permuted letter by letter within their alphabets.  Secrets of 4 to 7 characters have a
letter and a digit.  A bare run of ten digits is no phone number: ids look alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table
from .divergence import let

KEY = "quarry-demo-key"     # a parameter; use a secret one
ROUNDS = 8

# Formats of the kinds, tried at each place in this order.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}"
PHONE = (r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1[ .-]?\(?[2-9]\d{2}\)?[ .-]?[2-9]\d{2}[ .-]?\d{4}(?!\d)"
         r"|(?<![\d-])\(?[2-9]\d{2}\)?[ -][2-9]\d{2}-\d{4}(?![\d-])"
         r"|(?<![\d.-])(?:1[.-])?[2-9]\d{2}(?:\.[2-9]\d{2}\.|-[2-9]\d{2}-)\d{4}(?!\d|[.-]\d)")
FOREIGN = r"(?<![\d+])\+[2-9](?:[ .()-]{0,2}\d){7,14}(?![ .-]?\d)"
IPV6 = (r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?=[A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)")
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
ISO_DATE = r"(?<![\d-])(?:19|20)\d{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])"
DAY_DATE = r"(?<![\d./])(?:0[1-9]|[12]\d|3[01])([./])(?:0[1-9]|1[0-2])\1(?:19|20)\d{2}(?![\d/]|\.\d)"
CARD = r"(?<![\d-])\d{4}(?:[ -]?\d{4}){3}(?![\d-])"
LONG_CARD = r"(?<![\d.,-])(?:3[47]\d{2}[ -]\d{6}[ -]\d{5}|[3-6]\d{12,14}|[3-6]\d{16,18})(?![\d-]|[.,]\d)"
ACCESS = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
# A secret ends where its characters end, at any length; mail addresses, IPs and dates are their own kinds.
SECRET = (r"(?i:password|passwd|token|secret|api_?key) ?[=:] ?\"?(?!" + MAIL + r")"
          r"(?!(?:(?:\d{1,3}\.){3}\d{1,3}|\d{2}[./]\d{2}[./]\d{4})(?![A-Za-z0-9_/+=-]|\.\d))"
          r"(?:[A-Za-z0-9_./+=-]{7,}[A-Za-z0-9_-]"
          r"|(?=[A-Za-z_./+=-]*\d)(?=[0-9_./+=-]*[A-Za-z])[A-Za-z0-9_./+=-]{3,6}[A-Za-z0-9_-])\"?")
KINDS = {"mail": MAIL, "phone": PHONE, "foreign": FOREIGN, "ip": IPV4, "ip6": IPV6, "ssn": SSN, "iso": ISO_DATE,
         "day": DAY_DATE, "card": CARD, "long": LONG_CARD, "access": ACCESS, "secret": SECRET}
ANY = "|".join(KINDS.values()).replace(r"([./])", r"(?<sep>[./])").replace(r"\1", r"\k<sep>")

SECRET_HEAD = r"^(?i:password|passwd|token|secret|api_?key) ?[=:] ?\"?"
DIGITS, HEX, LOWER, UPPER = "0123456789", "abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX_SETS = [DIGITS, HEX, HEX.upper()]
# Spans of days that are a product of two small numbers, so that a day is two
# symbols and no value falls outside: (first day, days, second factor).
SPANS = [("1900-01-01", 18_262, 397), ("1950-01-01", 36_525, 487), ("2050-01-01", 18_262, 397)]


def feistel(symbols: Column, radix: Column, key: str, kind: Column, rounds: int = ROUNDS) -> Column:
    """Permute an array of whole numbers, ``0 <= symbols[i] < radix[i]``: in each
    round the halves change places, and the one that goes second has the round
    function of the other added, position by position.  ``rounds`` is even, so
    that each half ends where it began."""
    n = F.size(symbols)
    half = F.floor(n / 2).cast("int")
    start = F.struct(*[c.cast("array<int>").alias(name) for name, c in (
        ("a", F.slice(symbols, 1, half)), ("b", F.slice(symbols, half + 1, n - half)),
        ("ra", F.slice(radix, 1, half)), ("rb", F.slice(radix, half + 1, n - half)))])

    def one(s: Column, rnd: Column) -> Column:
        # 16 bits for each position; beyond 32 positions the bits are used again
        stream = F.sha2(F.concat_ws("|", F.lit(key), kind, rnd.cast("string"), F.concat_ws(
            ",", s["b"].cast("array<string>"))), 512)
        moved = let(stream, lambda p: F.transform(
            F.arrays_zip(s["a"].alias("x"), s["ra"].alias("r")), lambda z, i: F.pmod(
                z["x"] + F.conv(F.substring(p, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int"),
                z["r"]).cast("int")))
        return F.struct(s["b"].alias("a"), moved.alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one, lambda s: F.concat(s["a"], s["b"]))


def _chars(v: Column) -> Column:
    return F.filter(F.split(v, ""), lambda c: c != "")


def _code(c: Column, sets: list[str]) -> Column:
    """Place of a character in its alphabet; null outside all."""
    out = F.lit(None).cast("int")
    for s in sets:
        out = F.when(F.instr(F.lit(s), c) > 0, F.instr(F.lit(s), c) - 1).otherwise(out)
    return out


def _radix(c: Column, sets: list[str]) -> Column:
    out = F.lit(None).cast("int")
    for s in sets:
        out = F.when(F.instr(F.lit(s), c) > 0, F.lit(len(s))).otherwise(out)
    return out


def _char(c: Column, x: Column, sets: list[str]) -> Column:
    """Symbol ``x`` in the alphabet of ``c``; characters outside all stay."""
    out = c
    for s in sets:
        out = F.when(F.instr(F.lit(s), c) > 0, F.substring(F.lit(s), x + 1, F.lit(1))).otherwise(out)
    return out


def _write(v: Column, new: Column, sets: list[str]) -> Column:
    """``v`` with its k-th character of the alphabets replaced by the k-th symbol
    (short values: the work grows with the square of the length)."""
    return let(_chars(v), lambda cs: F.array_join(F.transform(cs, lambda c, i: _char(c, F.coalesce(F.get(
        new, F.size(F.filter(F.slice(cs, F.lit(1), i), lambda d: _code(d, sets).isNotNull()))), F.lit(0)), sets)), ""))


def _write_all(v: Column, new: Column, sets: list[str]) -> Column:
    """``v`` with one symbol for every character."""
    return F.array_join(F.zip_with(_chars(v), new, lambda c, x: _char(c, x, sets)), "")


def _ints(*values) -> Column:
    return F.array(*[x if isinstance(x, Column) else F.lit(x) for x in values]).cast("array<int>")


def luhn_sum(digits: Column) -> Column:
    """Sum of digits, every second from the right but one doubled, for an array
    that ends in its check digit."""
    n = F.size(digits)
    parts = F.transform(digits, lambda d, i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.when(
        d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b)


def _letters(core: Column, sets: list[str]) -> Column:
    """One symbol for every character; outside the alphabets 0, with range 1."""
    return F.struct(F.transform(_chars(core), lambda c: F.coalesce(_code(c, sets), F.lit(0))).cast("array<int>").alias("s"),
                    F.transform(_chars(core), lambda c: F.coalesce(_radix(c, sets), F.lit(1))).cast("array<int>").alias("r"))


def _digits(v: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(v, r"\D", "")), lambda c: c.cast("int"))


def _date(v: Column, kind: Column) -> Column:
    return F.when(kind == "iso", F.try_to_date(v, "yyyy-MM-dd")).otherwise(
        F.try_to_date(F.translate(v, "/", "."), "dd.MM.yyyy"))


def kind_of(v: Column) -> Column:
    out = F.lit("none")
    for k, p in reversed(KINDS.items()):
        out = F.when(F.regexp_like(v, F.lit(f"^(?:{p})$")), F.lit(k)).otherwise(out)
    return F.when((out == "secret") & F.regexp_like(_core(v, out), F.lit(r"^[0-9a-f]+$")), F.lit("hex")).when(
        out.isin("iso", "day") & _date(v, out).isNull(), F.lit("none")).when(
        (out == "long") & F.when(out == "long", luhn_sum(_digits(v)) % 10 != 0), F.lit("none")).otherwise(out)


def _core(v: Column, kind: Column) -> Column:
    """The part of a mail address or secret that is permuted."""
    return (F.when(kind == "mail", F.substring_index(v, "@", 1)).when(kind == "access", F.substr(v, F.lit(5)))
            .otherwise(F.regexp_replace(v, SECRET_HEAD + r"|\"$", "")))


def _first_digits(x: Column) -> Column:
    """Start of each digit's range in a phone number of ten digits."""
    return F.transform(x, lambda a, i: F.when(i.isin(0, 3) & (a >= 2), 2).otherwise(0))


def symbols_of(v: Column, kind: Column) -> Column:
    """struct(s: symbols, r: their ranges) of a value."""
    def pair(s: Column, r: Column) -> Column:
        return F.struct(s.cast("array<int>").alias("s"), r.cast("array<int>").alias("r"))

    d = _digits(v)
    o = F.transform(F.split(v, r"\."), lambda x: x.cast("int"))
    unicast, zero = o[0].between(1, 223), o[0] == 0
    area, group, serial = (F.substring(v, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    date = _date(v, kind)
    day = pair(_ints(), _ints())
    for first, days, r in SPANS:
        off = F.datediff(date, F.lit(first).cast("date"))
        day = F.when(off >= 0, pair(_ints(F.floor(off / r), F.pmod(off, F.lit(r))), _ints(days // r, r))).otherwise(day)
    return (F.when(kind.isin("mail", "access", "secret"), let(_core(v, kind), lambda c: _letters(c, [DIGITS, LOWER, UPPER])))
            .when(kind == "hex", let(_core(v, kind), lambda c: _letters(c, [DIGITS, HEX])))
            # a country code stays; the first digits of area code and exchange stay in
            # their range (2 to 9 by the plan, 0 and 1 outside it)
            .when(kind == "phone", let(F.slice(d, F.size(d) - 9, F.lit(10)), lambda x: pair(
                F.zip_with(x, _first_digits(x), lambda a, b: a - b),
                F.transform(x, lambda a, i: F.when(~i.isin(0, 3), 10).when(a >= 2, 8).otherwise(2)))))
            # the first octet stays in its range (0, 1 to 223, 224 to 255)
            .when(kind == "ip", let(o, lambda x: pair(
                _ints(x[1], x[2], x[3], F.when(unicast, x[0] - 1).when(zero, 0).otherwise(x[0] - 224)),
                _ints(256, 256, 256, F.when(unicast, 223).when(zero, 1).otherwise(32)))))
            # area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999
            .when(kind == "ssn", pair(_ints(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1),
                                      _ints(898, 99, 9999)))
            .when(kind.isin("iso", "day"), day)
            # the first digit (the scheme) and the check digit apart
            .when(kind.isin("card", "long"), let(F.slice(d, F.lit(2), F.size(d) - 2), lambda x: pair(
                x, F.transform(x, lambda a: F.lit(10)))))
            .when(kind == "foreign", let(F.slice(d, F.lit(3), F.size(d)), lambda x: pair(x, F.transform(x, lambda a: F.lit(10)))))
            .when(kind == "ip6", _letters(v, HEX_SETS))
            .otherwise(pair(_ints(), _ints())))


def render(v: Column, kind: Column, p: Column) -> Column:
    """The value of ``v``'s format with the symbols ``p``."""
    text = F.lit("")
    d = _digits(v)

    def card(x: Column) -> Column:
        # the check digit is wrong by as much as it was (valid: by nothing)
        wrong = luhn_sum(x)
        body = F.concat(F.slice(x, 1, 1), p, _ints(0))
        return F.concat(F.slice(x, 1, 1), p, F.array(F.pmod(wrong - luhn_sum(body), F.lit(10)).cast("int")))

    def phone(x: Column) -> Column:
        low = _first_digits(F.slice(x, F.size(x) - 9, F.lit(10)))
        return F.concat(F.slice(x, F.lit(1), F.size(x) - 10), F.zip_with(p, low, lambda a, b: a + b))

    first = F.split(v, r"\.")[0].cast("int")
    ip = F.concat_ws(".", (p[3] + F.when(first.between(1, 223), 1).when(first == 0, 0).otherwise(224)).cast("string"),
                     p[0].cast("string"), p[1].cast("string"), p[2].cast("string"))
    ssn = F.concat_ws("-", F.lpad(F.when(p[0] >= 665, p[0] + 2).otherwise(p[0] + 1).cast("string"), 3, "0"),
                      F.lpad((p[1] + 1).cast("string"), 2, "0"), F.lpad((p[2] + 1).cast("string"), 4, "0"))
    date, new = _date(v, kind), F.lit(None).cast("date")
    for start, _, r in SPANS:
        new = F.when(date >= F.lit(start).cast("date"), F.date_add(F.lit(start).cast("date"), p[0] * r + p[1])).otherwise(new)
    sep = F.substring(v, 3, 1)
    day = F.concat(F.date_format(new, "dd"), sep, F.date_format(new, "MM"), sep, F.date_format(new, "yyyy"))
    core = _core(v, kind)
    head = F.when(kind == "access", F.lit("AKIA")).when(kind == "mail", text).otherwise(
        F.regexp_extract(v, SECRET_HEAD, 0))
    tail = F.when(kind == "mail", F.substr(v, F.instr(v, F.lit("@")))).otherwise(F.regexp_extract(v, r"\"?$", 0))
    return (F.when(kind == "phone", _write(v, let(d, phone), [DIGITS])).when(kind.isin("card", "long"), _write(v, let(d, card), [DIGITS]))
            .when(kind == "foreign", _write(v, let(d, lambda x: F.concat(F.slice(x, 1, 2), p)), [DIGITS]))
            .when(kind == "ip6", _write_all(v, p, HEX_SETS))
            .when(kind == "ip", ip).when(kind == "ssn", ssn).when(kind == "iso", F.date_format(new, "yyyy-MM-dd"))
            .when(kind == "day", day).when(kind == "none", v)
            .when(kind == "hex", F.concat(head, _write_all(core, p, [DIGITS, HEX]), tail))
            .otherwise(F.concat(head, _write_all(core, p, [DIGITS, LOWER, UPPER]), tail)))


def pseudonym(v: Column, key: str) -> Column:
    """The pseudonym of one found value; a date that the calendar doesn't have stays."""
    return let(kind_of(v), lambda k: let(symbols_of(v, k), lambda s: let(
        feistel(s["s"], s["r"], key, k), lambda p: render(v, k, p))))


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal values in the text replaced; ``count_col``: a
    further column with their number.  Null text stays null; texts without any
    stay as they are; every row is treated alike, whatever its other columns."""
    text = F.col(f"`{text_col}`")
    m = free_name(docs, "_found")
    # no kind is without a digit, an at sign, an equals sign or a colon
    some = F.regexp_like(text, F.lit("[0-9@=:]"))
    step = docs.withColumn(m, F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    gaps = F.split(text, ANY, -1)

    def weave(parts: Column, found: Column) -> Column:
        # one gap more than values; the last gap has no value after it
        return F.array_join(F.zip_with(parts, F.transform(found, lambda v: pseudonym(v, key)),
                                       lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")

    new = F.when(F.size(F.col(m)) > 0, let(gaps, lambda g: weave(g, F.col(m)))).otherwise(text)
    out = step.withColumn(text_col, new)
    if count_col:
        valid = F.filter(F.col(m), lambda v: kind_of(v) != "none")
        out = out.withColumn(count_col, F.when(F.col(m).isNull(), 0).otherwise(F.size(valid)))
    return out.drop(m)


def op3_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, count_col="n_replaced")
