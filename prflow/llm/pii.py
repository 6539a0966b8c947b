"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Numbers and dates that pass their check are permuted within their format: a
card number stays a valid card number, a date a real date, an address an
address. The permutation depends on the key and the value only, so equal
values get equal pseudonyms in all documents, and different ones stay apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import let

ROUNDS = 8
CYCLE_DAYS = 146_097  # days of 400 years: 189 * 773
LETTERS = 12  # letters of one block of an address name

EMAIL = r"[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}"
YMD = r"\d{4}([-/.])\d{2}\1\d{2}"
DMY = r"\d{2}([-/.])\d{2}\2\d{4}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
PHONE = r"\+\d{1,3} ?\(\d{3}\) ?\d{3}-\d{4}|\+\d{1,3}[ -]\d{3}[ -]\d{3}[ -]\d{4}|\(\d{3}\) \d{3}-\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
CARD = r"\d{4}([ -]?)\d{4}\3\d{4}\3\d{1,7}|\d{13,19}"
FOUND = rf"(?<![\w.%+@-])(?:{EMAIL}|{YMD}|{DMY}|{IP}|{SSN}|{CARD})(?![\w@]|[.-]\d)|(?<![\w])(?:{PHONE})(?!\w)"


def _digest(key: str, tag: str, *parts: Column) -> Column:
    """60 pseudo-random bits of the key, the format and the parts."""
    text = F.concat_ws("|", F.lit(key), F.lit(tag), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a, b, key: str, tag: str, tweak: Column | None = None) -> Column:
    """Permutes pairs of 0 <= left < a, 0 <= right < b; a struct (l, r).

    Rounds add a keyed digest of one side to the other, modulo its size, so
    each round and the whole can be undone for any two sizes."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (a, b))
    tweak = F.lit(0) if tweak is None else tweak
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0,
            F.struct(F.pmod(s["l"] + F.pmod(_digest(key, tag, a, b, tweak, i, s["r"]), a), a).alias("l"), s["r"].alias("r")),
        ).otherwise(
            F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(_digest(key, tag, a, b, tweak, i, s["l"]), b), b).alias("r"))
        )

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def _power(n: Column, base: int) -> Column:
    return F.element_at(F.array(*[F.lit(base**i) for i in range(10)]), n + 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def permute_digits(digits: Column, key: str, tag: str) -> Column:
    """Another string of as many digits (up to 18)."""

    def split(d: Column) -> Column:
        n = F.length(d)
        low = F.floor(n / 2).cast("int")
        high = n - low
        left = d.substr(F.lit(1), high).cast("long")
        right = F.when(low > 0, d.substr(high + 1, low)).otherwise("0").cast("long")
        out = let(
            feistel(left, right, _power(high, 10), _power(low, 10), key, tag),
            lambda s: F.concat(
                F.lpad(s["l"].cast("string"), high, "0"),
                F.when(low > 0, F.lpad(s["r"].cast("string"), low, "0")).otherwise(""),
            ),
        )
        return out

    return F.when(F.length(digits) == 0, "").otherwise(let(digits, split))


def refill(value: Column, digits: Column) -> Column:
    """The value with its digits replaced, in order; other characters stay."""

    def fill(d: Column) -> Column:
        chars = F.split(value, "")
        return F.aggregate(
            chars, F.struct(F.lit("").alias("t"), F.lit(1).alias("n")),
            lambda s, c: F.when(
                c.rlike("[0-9]"),
                F.struct(F.concat(s["t"], d.substr(s["n"], F.lit(1))).alias("t"), (s["n"] + 1).alias("n")),
            ).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["n"].alias("n"))),
        )["t"]

    return let(digits, fill)


def check_sum(digits: Column, shift: int) -> Column:
    """Sum modulo 10 with every second digit doubled, from the right; ``shift``
    1 doubles the last one too (a payload whose check digit is missing)."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: let(
            c.cast("int") * F.when((i + shift) % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)
        ),
    )
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda s, x: s + x), F.lit(10))


def _card(value: Column, key: str) -> Column:
    def renewed(d: Column) -> Column:
        payload = permute_digits(d.substr(F.lit(1), F.length(d) - 1), key, "card")
        return let(payload, lambda p: F.concat(p, F.pmod(10 - check_sum(p, 1), F.lit(10)).cast("string")))

    return let(_digits(value), lambda d: F.when(check_sum(d, 0) == 0, refill(value, renewed(d))))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))

    def renewed(o: Column) -> Column:
        out = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        text = let(out, lambda s: F.concat_ws(
            ".", F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256
        ))
        return F.when(F.array_max(o) < 256, text)

    return let(octets, renewed)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""

    def renewed(d: Column) -> Column:
        area, group, serial = d.substr(1, 3).cast("int"), d.substr(4, 2).cast("int"), d.substr(6, 4).cast("int")
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        number = area - F.when(area > 666, 2).otherwise(1)
        out = feistel(number * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")

        def text(s: Column) -> Column:
            back = F.floor(s["l"] / 99)
            back = back + F.when(back >= 665, 2).otherwise(1)
            return F.concat_ws(
                "-", F.lpad(back.cast("string"), 3, "0"), F.lpad((s["l"] % 99 + 1).cast("string"), 2, "0"),
                F.lpad((s["r"] + 1).cast("string"), 4, "0"),
            )

        return F.when(valid, let(out, text))

    return let(_digits(value), renewed)


def _date(value: Column, key: str, year_first: bool) -> Column:
    """Another day of the same 400 years (from 1600, 2000, ...)."""

    def renewed(d: Column) -> Column:
        if year_first:
            y, m, day = d.substr(1, 4), d.substr(5, 2), d.substr(7, 2)
        else:
            y, m, day = d.substr(5, 4), d.substr(3, 2), d.substr(1, 2)
        y, m, day = y.cast("int"), m.cast("int"), day.cast("int")
        leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
        longest = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
        valid = (y >= 1600) & m.between(1, 12) & (day >= 1) & (day <= longest)
        days = F.datediff(F.make_date(y, m, day), F.lit("1600-01-01").cast("date"))

        def moved(n: Column) -> Column:
            out = feistel(F.floor((n % CYCLE_DAYS) / 773), (n % CYCLE_DAYS) % 773, 189, 773, key, "date")
            new = let(out, lambda s: F.date_add(
                F.lit("1600-01-01").cast("date"),
                (F.floor(n / CYCLE_DAYS) * CYCLE_DAYS + s["l"] * 773 + s["r"]).cast("int"),
            ))
            return F.date_format(new, "yyyyMMdd" if year_first else "ddMMyyyy")

        return F.when(valid, refill(value, let(days, moved)))

    return let(_digits(value), renewed)


def _email(value: Column, key: str) -> Column:
    """The name gets other letters and digits; the rest stays. Letters a-z are
    permuted in blocks; names with other letters draw letters by digest."""
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    small = F.lower(name)
    letters = F.regexp_replace(small, r"[^\p{L}]", "")
    other = letters.rlike("[^a-z]")

    def block(text: Column, i: Column) -> Column:
        part = text.substr(i * LETTERS + 1, F.lit(LETTERS))

        def number(t: Column) -> Column:
            return F.aggregate(
                F.filter(F.split(t, ""), lambda c: c != ""), F.lit(0).cast("long"),
                lambda s, c: s * 26 + F.ascii(c) - 97,
            )

        def spelled(x: Column, n: Column) -> Column:
            places = F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda p: F.char(F.pmod(F.floor(x / _power(n - 1 - p, 26)), F.lit(26)) + 97),
            )
            return F.when(n > 0, F.array_join(places, "")).otherwise("")

        def renewed(t: Column) -> Column:
            n = F.length(t)
            low = F.floor(n / 2).cast("int")
            high = n - low
            out = feistel(
                number(t.substr(F.lit(1), high)), number(t.substr(high + 1, low)),
                _power(high, 26), _power(low, 26), key, "name", i,
            )
            return let(out, lambda s: F.concat(spelled(s["l"], high), spelled(s["r"], low)))

        return let(part, renewed)

    permuted = let(letters, lambda t: F.array_join(
        F.transform(F.sequence(F.lit(0), F.floor((F.length(t) - 1) / LETTERS).cast("int")), lambda i: block(t, i)), ""
    ))
    drawn = F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.char(F.pmod(_digest(key, "drawn", small, i), F.lit(26)) + 97)), ""
    )
    fresh = F.when(F.length(letters) == 0, "").when(other, drawn).otherwise(permuted)
    digits = _digits(name)
    blocks = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.floor((F.greatest(F.length(digits), F.lit(1)) - 1) / 18).cast("int")),
            lambda i: permute_digits(digits.substr(i * 18 + 1, F.lit(18)), key, "name"),
        ), "",
    )

    def fill(new: Column) -> Column:
        return F.aggregate(
            F.split(name, ""),
            F.struct(F.lit("").alias("t"), F.lit(1).alias("a"), F.lit(1).alias("d")),
            lambda s, c: F.when(
                c.rlike(r"\p{L}"),
                F.struct(F.concat(s["t"], let(
                    new["letters"].substr(s["a"], F.lit(1)),
                    lambda x: F.when(c.rlike(r"\p{Lu}"), F.upper(x)).otherwise(x),
                )).alias("t"), (s["a"] + 1).alias("a"), s["d"].alias("d")),
            ).when(
                c.rlike("[0-9]"),
                F.struct(F.concat(s["t"], new["digits"].substr(s["d"], F.lit(1))).alias("t"), s["a"].alias("a"), (s["d"] + 1).alias("d")),
            ).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["a"].alias("a"), s["d"].alias("d"))),
        )["t"]

    new = F.struct(fresh.alias("letters"), blocks.alias("digits"))
    return F.concat(let(new, fill), F.lit("@"), domain)


def _phone(value: Column, key: str) -> Column:
    """The last ten digits; the country code stays."""

    def renewed(d: Column) -> Column:
        code = F.length(d) - 10
        return F.concat(d.substr(F.lit(1), code), permute_digits(d.substr(code + 1, F.lit(10)), key, "phone"))

    return refill(value, let(_digits(value), renewed))


KINDS = [
    ("email", "@", _email),
    ("date", rf"^\d{{4}}([-/.])\d{{2}}\1\d{{2}}$", lambda v, k: _date(v, k, True)),
    ("date", r"^\d{2}([-/.])\d{2}\1\d{4}$", lambda v, k: _date(v, k, False)),
    ("ip", rf"^{IP}$", _ip),
    ("phone", r"^(\+\d{1,3}[ -]?)?\(?\d{3}\)?[ -]?\d{3}-\d{4}$|^\+", _phone),
    ("ssn", rf"^{SSN}$", _ssn),
    ("card", r"^[\d -]+$", _card),
]


def pseudonym(value: Column, key: str) -> Column:
    """A struct (kind, new) for one found value; ``new`` is null if it fails
    the check of its format, and then it is no personal data."""

    def of(v: Column) -> Column:
        pairs = [(kind, v.rlike(pattern), make(v, key)) for kind, pattern, make in KINDS]
        kind = reduce(lambda w, p: w.when(p[1], p[0]), pairs[1:], F.when(pairs[0][1], pairs[0][0]))
        new = reduce(lambda w, p: w.when(p[1], p[2]), pairs[1:], F.when(pairs[0][1], pairs[0][2]))
        return F.struct(kind.alias("kind"), new.alias("new"))

    return let(value, of)


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The input with its text replaced and ``replaced``: an array of the kinds
    of the values replaced, in order.

    Email addresses, IPv4 addresses, phone, card and social security numbers
    and numeric dates (year first, or day first) are found; cards must have a
    right check digit, addresses right octets, dates must exist (1600-9999).
    What fails its check stays as it is. ``key`` is a secret of the caller.
    Names of addresses with letters outside a-z draw letters by digest: equal
    ones stay linked, but two of them could meet in one pseudonym.

    A projection only: no shuffle, so no key can be hot, and texts of any
    length are read whole. Null texts stay null, with nothing replaced;
    repeated rows get the same result; an empty table gives an empty result;
    an input column ``replaced`` is overwritten, all others are kept.
    """
    raw = F.col(text)
    found = F.transform(
        F.regexp_extract_all(raw, F.lit(FOUND), F.lit(0)),
        lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("p")),
    )
    def rebuilt(f: Column) -> Column:
        pieces = F.split(raw, FOUND, -1)
        new = F.transform(f, lambda x: F.coalesce(x["p"]["new"], x["old"]))
        return F.struct(
            F.array_join(F.zip_with(pieces, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "").alias("text"),
            F.transform(F.filter(f, lambda x: x["p"]["new"].isNotNull()), lambda x: x["p"]["kind"]).alias("kinds"),
        )

    nothing = F.struct(raw.alias("text"), F.array().cast("array<string>").alias("kinds"))
    out = F.when(raw.rlike("[0-9@]"), F.when(raw.rlike(FOUND), let(found, rebuilt))).otherwise(nothing)
    names = [c for c in docs.columns if c.lower() != "replaced"]
    done = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(out, nothing).alias("done"))
    columns = [F.col("done.text" if c.lower() == text.lower() else f"row.`{c}`").alias(c) for c in names]
    return done.select(*columns, F.col("done.kinds").alias("replaced"))
