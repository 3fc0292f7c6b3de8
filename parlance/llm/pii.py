"""Format-preserving pseudonyms for personal data, as Spark expressions only.

Validated values are permuted by a keyed Feistel network inside their own format: a card
number becomes another number with a right check digit, a date another date of the same
century in the same notation, an address another address. The permutation depends on
the key and the value alone, so equal values stay equal in all documents, and different
values stay different. Without the key it cannot be undone.

A round adds, modulo the size of its half, a number drawn from SHA-256 of key, kind,
round and the other half; halves need not be equally large, so a domain of p * q values
is permuted exactly. Values of letters and digits (mail names, secrets) shift every
character of one half inside its class (digit, capital, small letter) by bytes of the
digest of the other half.
"""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Kind -> pattern. Every pattern starts at a place no longer match could have covered and
# repeats possessively, so that scanning is linear in the text.
_START, _END = r"(?<![A-Za-z0-9._%+@-])", r"(?![A-Za-z0-9])"
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}",
    "date_iso": _START + r"(?:1[6-9]|2[0-9])[0-9]{2}-[0-9]{2}-[0-9]{2}" + r"(?![0-9-])",
    "date_dmy": _START + r"[0-9]{2}[./][0-9]{2}[./](?:1[6-9]|2[0-9])[0-9]{2}" + r"(?![0-9./]*[0-9])",
    "ssn": _START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + r"(?![0-9-])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}" + _END,
    "phone_intl": r"(?<![A-Za-z0-9+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,6}" + _END,
    "ip": _START + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + r"(?![0-9]|\.[0-9])",
    "card": _START + r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}" + r"(?![0-9A-Za-z-])",
    "aws_key": _START + r"A[KS]IA[A-Z0-9]{16}" + _END,
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|secret|token|api_key|apikey)[ ]?[=:][ ]?[\"']?[A-Za-z0-9+/_-]{8,512}+",
}
KINDS = list(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MAYBE = r"[0-9@]|(?i:password|passwd|secret|token|api_?key)"


def _drawn(key: Column, kind: str, round_no: Column, value: Column, below: Column) -> Column:
    """A number under ``below`` fixed by key, kind, round and value."""
    digest = F.sha2(F.concat_ws("|", key, F.lit(kind), round_no.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % below


def feistel(a: Column, b: Column, p: Column, q: Column, key: Column, kind: str) -> Column:
    """Permutes ``(a, b)``, 0 <= a < p and 0 <= b < q; struct of the new a and b."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, r):
        even = r % 2 == 0
        return F.struct(
            F.when(even, (s["a"] + _drawn(key, kind, r, s["b"], p)) % p).otherwise(s["a"]).cast("long").alias("a"),
            F.when(even, s["b"]).otherwise((s["b"] + _drawn(key, kind, r, s["a"], q)) % q).cast("long").alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _char(c: Column, by: Column) -> Column:
    """A character shifted inside its class; others stay."""
    code = F.ascii(c)
    turn = lambda first, n: F.chr((code - first + by) % n + first)
    return (F.when(c.between("0", "9"), turn(48, 10)).when(c.between("A", "Z"), turn(65, 26))
            .when(c.between("a", "z"), turn(97, 26)).otherwise(c))


def shifted(value: Column, key: Column, kind: str) -> Column:
    """Permutes letters and digits of a string, every other character staying in place."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("a"),
                     F.substr(value, half + 1, F.length(value) - half).alias("b"))

    def turned(part, other, r):
        # One digest block per 32 characters; short values use a single one.
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.length(part) / 32).cast("int")),
            lambda k: F.sha2(F.concat_ws("|", key, F.lit(kind), r.cast("string"), k.cast("string"), other), 256))
        stream = F.array_join(blocks, "")
        by = lambda i: F.conv(F.substr(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        return F.array_join(F.transform(F.split(part, ""), lambda c, i: _char(c, by(i))), "")

    def step(s, r):
        even = r % 2 == 0
        return F.struct(F.when(even, turned(s["a"], s["b"], r)).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise(turned(s["b"], s["a"], r)).alias("b"))

    out = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(out["a"], out["b"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _put(v: Column, digits: Column, skip: Column | None = None) -> Column:
    """``v`` with its digits replaced in order by those of ``digits``; the rest stays."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))
    out = F.aggregate(F.split(v, ""), start, lambda s, c: F.when(
        c.between("0", "9"), F.struct(F.concat(s["out"], F.substr(digits, s["i"] + 1, F.lit(1))).alias("out"),
                                      (s["i"] + 1).alias("i"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))))
    return out["out"]


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule over a string of digits, its last digit undoubled."""
    parts = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                                           c.cast("int") + 1)))
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x)


def _card(v: Column, key: Column) -> Column:
    """First digit kept, the middle permuted, check digit set; only right numbers change."""
    d = _digits(v)
    n = F.length(d)
    middle = (n - 2).cast("int")
    left = F.floor(middle / 2).cast("int")
    right = middle - left
    ab = feistel(F.substr(d, F.lit(2), left), F.substr(d, left + 2, right), F.pow(F.lit(10), left).cast("long"),
                 F.pow(F.lit(10), right).cast("long"), key, "card")
    body = F.transform(F.array(ab), lambda x: F.concat(
        F.substr(d, F.lit(1), F.lit(1)), F.lpad(x["a"].cast("string"), left, "0"), F.lpad(x["b"].cast("string"), right, "0")))
    whole = F.transform(body, lambda t: F.concat(t, ((10 - _luhn(F.concat(t, F.lit("0"))) % 10) % 10).cast("string")))
    return F.when(n.between(13, 19) & (_luhn(d) % 10 == 0), _put(v, whole[0])).otherwise(v)


def _phone(v: Column, key: Column) -> Column:
    """North American numbers: area 200-999, exchange 200-999, line; a leading 1 stays."""
    d = _digits(v)
    ten = F.substr(d, F.length(d) - 9, F.lit(10))
    ab = feistel(F.substr(ten, F.lit(1), F.lit(3)).cast("long") - 200, F.substr(ten, F.lit(4), F.lit(7)).cast("long") - 2_000_000,
                 F.lit(800), F.lit(8_000_000), key, "phone")
    new = F.transform(F.array(ab), lambda x: F.concat((x["a"] + 200).cast("string"), (x["b"] + 2_000_000).cast("string")))
    return _put(v, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), new[0]))


def _phone_intl(v: Column, key: Column) -> Column:
    """The plus and first digit stay, all other digits are permuted; 7 to 15 digits."""
    d = _digits(v)
    m = (F.length(d) - 1).cast("int")
    left = F.floor(m / 2).cast("int")
    ab = feistel(F.substr(d, F.lit(2), left), F.substr(d, left + 2, m - left), F.pow(F.lit(10), left).cast("long"),
                 F.pow(F.lit(10), m - left).cast("long"), key, "phone_intl")
    new = F.transform(F.array(ab), lambda x: F.concat(
        F.substr(d, F.lit(1), F.lit(1)), F.lpad(x["a"].cast("string"), left, "0"), F.lpad(x["b"].cast("string"), m - left, "0")))
    return F.when(F.length(d).between(7, 15), _put(v, new[0])).otherwise(v)


def _ip(v: Column, key: Column) -> Column:
    o = F.transform(F.split(v, r"\."), lambda c: c.cast("int"))
    ab = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
    new = F.transform(F.array(ab), lambda x: F.concat_ws(
        ".", F.floor(x["a"] / 256).cast("string"), (x["a"] % 256).cast("string"),
        F.floor(x["b"] / 256).cast("string"), (x["b"] % 256).cast("string")))
    return F.when(F.forall(o, lambda x: x < 256), new[0]).otherwise(v)


def _ssn(v: Column, key: Column) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
    area, group, serial = [F.split(v, "-")[i].cast("long") for i in range(3)]
    ab = feistel(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1,
                 F.lit(898), F.lit(99 * 9999), key, "ssn")
    new = F.transform(F.array(ab), lambda x: F.concat_ws(
        "-", F.lpad((x["a"] + 1 + F.when(x["a"] >= 665, 1).otherwise(0)).cast("string"), 3, "0"),
        F.lpad((F.floor(x["b"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((x["b"] % 9999 + 1).cast("string"), 4, "0")))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    return F.when(valid, new[0]).otherwise(v)


def _day(day: Column, key: Column) -> Column:
    """Another day of the same century: 36525 = 75 * 487 or 36524 = 92 * 397 days."""
    century = F.floor(F.year(day) / 100).cast("int")
    first = F.make_date(century * 100, F.lit(1), F.lit(1))
    long_ = century % 4 == 0
    p, q = F.when(long_, 75).otherwise(92), F.when(long_, 487).otherwise(397)
    at = F.datediff(day, first)
    ab = feistel(F.floor(at / q), at % q, p, q, key, "date")
    return F.transform(F.array(ab), lambda x: F.date_add(first, (x["a"] * q + x["b"]).cast("int")))[0]


def _date_iso(v: Column, key: Column) -> Column:
    return F.coalesce(F.date_format(_day(v.try_cast("date"), key), "yyyy-MM-dd"), v)


def _date_dmy(v: Column, key: Column) -> Column:
    """Day, month, year, or month first where only that is a date; separators stay."""
    part = F.split(v, "[./]")
    sep1, sep2 = F.substr(v, F.lit(3), F.lit(1)), F.substr(v, F.lit(6), F.lit(1))
    dm = F.concat_ws("-", part[2], part[1], part[0]).try_cast("date")
    md = F.concat_ws("-", part[2], part[0], part[1]).try_cast("date")
    out = lambda day, one, two: F.concat(F.date_format(day, one), sep1, F.date_format(day, two), sep2, F.date_format(day, "yyyy"))
    return F.coalesce(out(_day(dm, key), "dd", "MM"), out(_day(md, key), "MM", "dd"), v)


def _mail(v: Column, key: Column) -> Column:
    """Name and host are permuted apart, so mails of one host keep one host; the top-level domain stays."""
    at = F.instr(v, "@")
    host = F.substr(v, at + 1, F.length(v) - at)
    top = F.substring_index(host, ".", -1)
    labels = F.substr(host, F.lit(1), F.length(host) - F.length(top) - 1)
    return F.concat(shifted(F.substr(v, F.lit(1), at - 1), key, "mail"), F.lit("@"),
                    shifted(labels, key, "host"), F.lit("."), top)


def _aws_key(v: Column, key: Column) -> Column:
    return F.concat(F.substr(v, F.lit(1), F.lit(4)), shifted(F.substr(v, F.lit(5), F.lit(16)), key, "aws_key"))


def _secret(v: Column, key: Column) -> Column:
    body = F.regexp_extract(v, r"[A-Za-z0-9+/_-]{8,}$", 0)
    return F.concat(F.substr(v, F.lit(1), F.length(v) - F.length(body)), shifted(body, key, "secret"))


MAKERS = {"mail": _mail, "date_iso": _date_iso, "date_dmy": _date_dmy, "ssn": _ssn, "phone": _phone,
          "phone_intl": _phone_intl, "ip": _ip, "card": _card, "aws_key": _aws_key, "secret": _secret}


def kind_of(v: Column) -> Column:
    """The kind of a matched value: the first whose pattern covers it all."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(v.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonym(v: Column, kind: Column, key: Column) -> Column:
    """The pseudonym of one matched value of a kind; unchanged where it is not valid."""
    out = v
    for k in reversed(KINDS):
        out = F.when(kind == k, MAKERS[k](v, key)).otherwise(out)
    return out


def _rewritten(df: DataFrame, key: str, text: str) -> tuple[DataFrame, list[Column], Column]:
    """A table, the columns of ``df`` over it with ``text`` rewritten, and ``(found, changed)``."""
    t = F.col(f"`{text}`")
    maybe = t.rlike(MAYBE)
    k = F.lit(key)
    found = F.when(maybe, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    seen = df.select(row.alias("row"), t.alias("t"), found.alias("found"))
    kinds = F.transform("found", lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind")))
    named = seen.select("row", "t", "found", F.transform(kinds, lambda x: pseudonym(x["v"], x["kind"], k)).alias("new"))
    between = F.split("t", ANY, -1)
    spliced = F.array_join(F.transform(
        F.arrays_zip(between.alias("gap"), F.col("new").alias("new")),
        lambda x: F.concat(x["gap"], F.coalesce(x["new"], F.lit("")))), "")
    rewritten = F.when(F.size("found") > 0, spliced).otherwise(F.col("t"))
    changed = F.size(F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda c: c))
    out = [rewritten.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    return named, out, F.struct(F.size("found").cast("long").alias("found"), changed.cast("long").alias("changed"))


def pseudonymised(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with ``text`` rewritten and ``pii_`` added: ``found``, ``changed`` (longs).

    NULL stays NULL, texts without personal data stay as they are, whole texts of any
    length are scanned. Rows are independent: repeated rows give repeated results. Extra
    columns stay, whatever their names, except ``pii_``. An empty table gives an empty one.
    """
    named, out, counts = _rewritten(df, key, text)
    return named.select(*out, counts.alias("pii_"))


def rewritten(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with ``text`` rewritten as by ``pseudonymised``, its columns only, whatever their names."""
    named, out, _ = _rewritten(df, key, text)
    return named.select(*out)
