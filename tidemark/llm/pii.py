"""Format-preserving pseudonyms for personal numbers and dates: keyed Feistel permutations in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: For tests and examples; a deployment passes its own secret.
DEMO_KEY = "not a secret"

# The shapes of the values looked for.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
DATE = r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z])(?!\.[0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])"
PATTERN = "|".join((MAIL, DATE, ADDRESS, PHONE, CARD))
#: Dates from the first of 1900 over 270 * 270 days, to August 2099, are permuted among themselves.
DAY_SIDE = 270
EPOCH = "DATE '1900-01-01'"

KINDS = ("mail", "date", "address", "phone", "card")


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 512)


def _number(key: str, *parts: Column) -> Column:
    """60 keyed pseudo-random bits."""
    return F.conv(F.substring(_digest(key, *parts), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str, forward: bool = True) -> Column:
    """A keyed permutation of the pairs (left < a, right < b), as a struct (l, r); backwards its inverse.

    Rounds add to one half, modulo its size, a keyed function of the other.
    """
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    sign = 1 if forward else -1

    def step(acc, n):
        even = n % 2 == 0
        moved = F.pmod(F.when(even, acc["l"]).otherwise(acc["r"]) + sign * F.pmod(_number(key, F.lit(kind), n, F.when(even, acc["r"]).otherwise(acc["l"])), F.when(even, a).otherwise(b)), F.when(even, a).otherwise(b))
        return F.struct(F.when(even, moved).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(moved).alias("r"))

    rounds = list(range(ROUNDS)) if forward else list(reversed(range(ROUNDS)))
    return F.aggregate(F.array(*map(F.lit, rounds)), start, step)


def _let(value: Column, function) -> Column:
    """``function`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), function), 1)


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    total = F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("s"), F.lit(1).alias("w")), lambda acc, c: F.struct((acc["s"] + _doubled(c.cast("int") * acc["w"])).alias("s"), (3 - acc["w"]).alias("w")))
    return total["s"] % 10 == 0


def _doubled(x: Column) -> Column:
    return F.when(x > 9, x - 9).otherwise(x)


def _check_digit(body: Column) -> Column:
    total = F.aggregate(F.split(F.reverse(body), ""), F.struct(F.lit(0).alias("s"), F.lit(2).alias("w")), lambda acc, c: F.struct((acc["s"] + _doubled(c.cast("int") * acc["w"])).alias("s"), (3 - acc["w"]).alias("w")))
    return ((10 - total["s"] % 10) % 10).cast("string")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _padded(x: Column, n: Column) -> Column:
    return F.lpad(x.cast("string"), n, F.lit("0"))


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order by those of ``digits``."""
    # spliced at the parts between digits: separators come with the digit after them
    parts = F.regexp_extract_all(shape, F.lit(r"[^0-9]*[0-9]"), F.lit(0))
    filled = F.zip_with(parts, F.sequence(F.lit(1), F.size(parts)), lambda p, i: F.concat(F.regexp_extract(p, r"^[^0-9]*", 0), F.substring(digits, i, F.lit(1))))
    return F.concat(F.array_join(filled, ""), F.regexp_extract(shape, r"[^0-9]*$", 0))


def _card(m: Column, key: str, forward: bool) -> Column:
    """The digits before the check digit are permuted among those of that length; the check digit follows them."""

    def change(d):
        n = F.length(d) - 1
        u = F.floor(n / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
        moved = feistel(F.substring(d, F.lit(1), u).cast("bigint"), F.substring(d, u + 1, n - u).cast("bigint"), ten(u), ten(n - u), key, "card", forward)
        return _let(_let(moved, lambda x: F.concat(_padded(x["l"], u), _padded(x["r"], n - u))), lambda body: _refill(m, F.concat(body, _check_digit(body))))

    return _let(_digits(m), change)


def _phone(m: Column, key: str, forward: bool) -> Column:
    """The ten digits of North American numbers: the area code and the other seven."""

    def change(d):
        d = F.right(d, F.lit(10))
        moved = feistel(F.substring(d, 1, 3).cast("bigint"), F.substring(d, 4, 7).cast("bigint"), F.lit(1_000), F.lit(10_000_000), key, "phone", forward)
        ten = _let(moved, lambda x: F.concat(_padded(x["l"], F.lit(3)), _padded(x["r"], F.lit(7))))
        return _refill(m, F.concat(F.when(m.startswith("+1"), F.lit("1")).otherwise(F.lit("")), ten))

    return _let(_digits(m), change)


def _address(m: Column, key: str, forward: bool) -> Column:
    """The 32 bits of a dotted address; leading zeros are not kept."""

    def change(p):
        of = lambda i: F.element_at(p, i).cast("bigint")
        moved = feistel(of(1) * 256 + of(2), of(3) * 256 + of(4), F.lit(65_536), F.lit(65_536), key, "address", forward)
        return _let(moved, lambda x: F.concat_ws(".", F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256))

    return _let(F.split(m, r"\."), change)


def _day(m: Column) -> Column:
    iso = F.concat_ws("-", F.substring(m, 1, 4), F.substring(m, 6, 2), F.substring(m, 9, 2))
    dotted = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    return F.datediff(F.when(m.rlike(r"^[0-9]{2}\."), dotted).otherwise(iso).try_cast("date"), F.expr(EPOCH))


def _date(m: Column, key: str, forward: bool) -> Column:
    """Days from 1900 to August 2099 are permuted; the way of writing stays."""

    def change(day):
        moved = feistel(F.floor(day / DAY_SIDE), day % DAY_SIDE, F.lit(DAY_SIDE), F.lit(DAY_SIDE), key, "date", forward)
        new = _let(moved, lambda x: F.date_add(F.expr(EPOCH), (x["l"] * DAY_SIDE + x["r"]).cast("int")))
        return _let(new, lambda t: F.when(m.rlike(r"^[0-9]{2}\."), F.date_format(t, "dd.MM.yyyy")).when(m.contains("/"), F.date_format(t, "yyyy/MM/dd")).otherwise(F.date_format(t, "yyyy-MM-dd")))

    return _let(_day(m), change)


def _mail(m: Column, key: str, forward: bool) -> Column:
    """Letters and digits of the local part, halves by turns, each shifted within its own class; the domain stays."""
    sign = 1 if forward else -1

    def shifted(half, digest):
        def one(c, i):
            shift = F.conv(F.substring(digest, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            turn = lambda first, n: F.chr(F.lit(ord(first)) + F.pmod(F.ascii(c) - ord(first) + sign * shift, F.lit(n)))
            return F.when(c.rlike("^[a-z]$"), turn("a", 26)).when(c.rlike("^[A-Z]$"), turn("A", 26)).when(c.rlike("^[0-9]$"), turn("0", 10)).otherwise(c)

        return F.transform(half, one)

    def change(local):
        u = F.floor(F.size(local) / 2).cast("int")
        start = F.struct(F.slice(local, F.lit(1), u).alias("l"), F.slice(local, u + 1, F.size(local) - u).alias("r"))

        def step(acc, n):
            even = n % 2 == 0
            digest = _digest(key, F.lit("mail"), n, F.when(even, F.array_join(acc["r"], "")).otherwise(F.array_join(acc["l"], "")))
            moved = _let(digest, lambda d: shifted(F.when(even, acc["l"]).otherwise(acc["r"]), d))
            return _let(moved, lambda x: F.struct(F.when(even, x).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(x).alias("r")))

        rounds = list(range(ROUNDS)) if forward else list(reversed(range(ROUNDS)))
        moved = F.aggregate(F.array(*map(F.lit, rounds)), start, step)
        return _let(moved, lambda x: F.concat(F.array_join(F.concat(x["l"], x["r"]), ""), F.regexp_extract(m, "@.*$", 0)))

    return _let(F.split(F.regexp_extract(m, "^[^@]*", 0), ""), change)


def kind_of(m: Column) -> Column:
    """The kind of a match that is valid, else null: check digits, ranges and the calendar decide."""
    octets = F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)
    day = _day(m)
    return (
        F.when(m.contains("@"), F.lit("mail"))
        .when(m.rlike(r"^(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})$"), F.when(day.between(0, DAY_SIDE * DAY_SIDE - 1), F.lit("date")))
        .when(m.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), F.when(octets, F.lit("address")))
        .when(m.rlike(r"^(?:\+|\(|[0-9]{3}[.-])"), F.lit("phone"))
        .otherwise(F.when(luhn(_digits(m)), F.lit("card")))
    )


def pseudonyms(docs: DataFrame, key: str = DEMO_KEY, forward: bool = True) -> DataFrame:
    """doc_id, text, and the number of values of each kind that were permuted, of every row of ``docs``.

    Card numbers with a right check digit, numbers written as North American telephones,
    IPv4 addresses, calendar dates from 1900 to August 2099 and the local parts
    of mail addresses become others of the same format.  A value, however it is
    written, always becomes the same one, in every document, and the key turns
    it back (``forward=False``).  What does not validate stays.  A null text
    stays null, an empty one empty; repeated rows come back as given; extra
    columns are ignored.
    """
    change = {"mail": _mail, "date": _date, "address": _address, "phone": _phone, "card": _card}

    def replaced(m):
        def by_kind(kind):
            out = F.lit(None).cast("string")
            for name in KINDS:
                out = F.when(kind == name, change[name](m, key, forward)).otherwise(out)
            return F.struct(kind.alias("kind"), F.coalesce(out, m).alias("value"))

        return _let(kind_of(m), by_kind)

    # gaps and matches stand side by side: one more gap than matches
    parts = F.struct(F.split("text", PATTERN, -1).alias("gaps"), F.transform(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), replaced).alias("found"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "text", F.inline(F.array(F.when(F.col("text").rlike(PATTERN), parts).otherwise(F.struct(F.array(F.col("text")).alias("gaps"), F.expr("CAST(array() AS array<struct<kind: string, value: string>>)").alias("found"))))))
    tail = F.zip_with(F.slice("gaps", F.lit(2), F.size("found")), F.col("found"), lambda g, f: F.concat(f["value"], g))
    text = F.when(F.size("found") == 0, F.col("text")).otherwise(F.concat(F.element_at("gaps", 1), F.array_join(tail, "")))
    of_kind = lambda kind: F.filter("found", lambda f: f["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", text.alias("text"), *counts)
