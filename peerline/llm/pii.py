"""Personal data replaced by keyed pseudonyms of the same format.

Every value is permuted by a Feistel network whose round function is SHA-256 over a secret
key, the kind of value and the other half. A permutation never joins two values, and
equal values get equal pseudonyms in every document, so records stay linked.
Numbers that follow a rule follow it afterwards: check digits are made anew, octets and
days stay in range, a leap year stays one.
"""

from __future__ import annotations

import functools
import secrets
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.llm.common import let
from peerline.operators.rows import fresh_name

ROUNDS = 8
KEY_SETTING = "spark.pseudonyms.key"

# The kinds of value and their patterns, in the order they are tried.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
HEX = (
    r"(?<![A-Za-z0-9])(?:(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})"
    r"|(?=[0-9A-F]*[0-9])(?=[0-9A-F]*[A-F])(?:[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32}))(?![A-Za-z0-9])"
)
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}[-/.](?:0[1-9]|1[0-2])[-/.](?:0[1-9]|[12][0-9]|3[01])|(?:0[1-9]|[12][0-9]|3[01])[-/.](?:0[1-9]|1[0-2])[-/.](?:19|20)[0-9]{2}|(?:0[1-9]|1[0-2])[-/.](?:1[3-9]|2[0-9]|3[01])[-/.](?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
INTERNATIONAL = r"(?<![0-9+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"


def _digest(key: str, kind: str, i: Column, half: Column) -> Column:
    """Two blocks of SHA-256, 128 hex digits."""
    block = lambda n: F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"{kind}.{n}"), i.cast("string"), half.cast("string")), 256)
    return F.concat(block(0), block(1))


def _number(digest: Column, start: Column | int, width: int) -> Column:
    return F.conv(F.substring(digest, start, width), 16, 10).cast("long")


def _shifted(text: Column, stream: Column, hexadecimal: bool) -> Column:
    """Each digit and letter moved on within its own class by the next byte of the stream, round and round."""

    def moved(c: Column, i: Column) -> Column:
        at, by = F.ascii(c), F.conv(F.substr(stream, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int")
        within = lambda low, size: F.char(F.lit(low) + (at - low + by) % size)
        letters = 6 if hexadecimal else 26
        return (
            F.when(at.between(48, 57), within(48, 10))
            .when(at.between(97, 122), within(97, letters))
            .when(at.between(65, 90), within(65, letters))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def permute_text(value: Column, kind: str, key: str, hexadecimal: bool = False) -> Column:
    """Another text with a digit for each digit, a letter for each letter, all else in place."""
    half = F.floor(F.char_length(value) / 2).cast("int")
    start = F.struct(
        F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1, F.char_length(value)).alias("r")
    )
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda s, i: F.struct(
            s["r"].alias("l"), _shifted(s["l"], _digest(key, kind, i, s["r"]), hexadecimal).alias("r")
        ),
        lambda s: F.concat(s["l"], s["r"]),
    )
    return done


def permute_pair(left: Column, right: Column, sizes: tuple[Column | int, Column | int], kind: str, key: str, body: Callable) -> Column:
    """`body(l, r)` of a pair permuted within sizes[0] x sizes[1]: the halves take turns."""
    a, b = (F.lit(s) if isinstance(s, int) else s for s in sizes)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        add = _number(_digest(key, kind, i, F.when(odd, s["r"]).otherwise(s["l"])), 1, 15)
        return F.struct(
            F.when(odd, (s["l"] + add % a) % a).otherwise(s["l"]).cast("long").alias("l"),
            F.when(odd, s["r"]).otherwise((s["r"] + add % b) % b).cast("long").alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: body(s["l"], s["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _pad(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def refill(value: Column, chars: Column) -> Column:
    """`value` with its digits, in order, replaced by those of `chars`."""

    def step(s: Column, c: Column) -> Column:
        digit = F.ascii(c).between(48, 57)
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(chars, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(
        F.split(value, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda s: s["out"]
    )


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, its last digit not doubled."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: let(
                c.cast("int") * (1 + i % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)
            ),
        ),
        F.lit(0),
        lambda total, d: total + d,
    )


def _card(m: Column, key: str) -> Column:
    """The first digit stays. The last one stays as far from the right check digit as it was, so right numbers stay right."""

    def of(d: Column) -> Column:
        n = F.char_length(d)
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_text(F.substr(d, F.lit(2), n - 2), "card", key))
        off = luhn_sum(d) % 10
        return let(body, lambda b: F.concat(b, ((10 + off - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))

    return refill(m, let(_digits(m), of))


def _iban_rest(text: Column) -> Column:
    """An IBAN-like text modulo 97, letters as two digits."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda r, c: F.when(F.ascii(c) >= 65, (r * 100 + F.ascii(c) - 55) % 97).otherwise((r * 10 + c.cast("int")) % 97),
    )


def _iban(m: Column, key: str) -> Column:
    """The country stays, the account is permuted, the check digits are made anew; a wrong IBAN stays as it is."""

    def of(v: Column) -> Column:
        rest = F.substr(v, F.lit(5), F.char_length(v))
        moved = let(
            permute_text(rest, "iban", key),
            lambda b: F.concat(
                F.substr(v, F.lit(1), F.lit(2)),
                F.lpad((98 - _iban_rest(F.concat(b, F.substr(v, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0"),
                b,
            ),
        )
        right = _iban_rest(F.concat(rest, F.substr(v, F.lit(1), F.lit(4)))) == 1
        spaced = F.regexp_replace(moved, "(.{4})(?=.)", "$1 ")
        return F.when(right, F.when(m.contains(" "), spaced).otherwise(moved)).otherwise(m)

    return let(F.replace(m, F.lit(" "), F.lit("")), of)


def _ip(m: Column, key: str) -> Column:
    octet = lambda n: F.split_part(m, F.lit("."), F.lit(n)).cast("int")
    return permute_pair(
        octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), (65536, 65536), "ip", key,
        lambda l, r: F.concat_ws(".", *[x.cast("string") for x in (F.floor(l / 256), l % 256, F.floor(r / 256), r % 256)]),
    )


def _ssn(m: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(n)).cast("int") for n in (1, 2, 3))
    def text(l: Column, r: Column) -> Column:  # noqa: E306
        a = l + 1 + (l >= 665).cast("int")
        return F.concat_ws("-", _pad(a, 3), _pad(F.floor(r / 9999) + 1, 2), _pad(r % 9999 + 1, 4))

    return permute_pair(area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1, (898, 99 * 9999), "ssn", key, text)


def _phone(m: Column, key: str) -> Column:
    """Area and exchange stay in 200-999, a leading 1 stays."""

    def of(d: Column) -> Column:
        lead = F.when(F.char_length(d) == 11, F.lit("1")).otherwise(F.lit(""))
        ten = F.right(d, F.lit(10))
        area, rest = F.substr(ten, F.lit(1), F.lit(3)).cast("int") - 200, F.substr(ten, F.lit(4), F.lit(7)).cast("int") - 2_000_000
        return permute_pair(area, rest, (800, 8_000_000), "phone", key, lambda l, r: F.concat(lead, _pad(l + 200, 3), _pad(r + 2_000_000, 7)))

    return refill(m, let(_digits(m), of))


def _international(m: Column, key: str) -> Column:
    """The first three digits, which hold the country, stay."""
    return refill(m, let(_digits(m), lambda d: F.concat(F.substr(d, F.lit(1), F.lit(3)), permute_text(F.substr(d, F.lit(4), F.lit(20)), "tel", key))))


def _date(m: Column, key: str) -> Column:
    """A day of 1900-2099 to another, common years and leap years each among themselves; no day, no change.

    A date whose middle number is above 12 has its month first, and so has its pseudonym; others begin with the year or the day. A
    month-first pseudonym may have a day up to 12.
    """
    year_first = F.substr(m, F.lit(5), F.lit(1)).isin("-", "/", ".")
    month_first = ~year_first & (F.substr(m, F.lit(4), F.lit(2)).try_cast("int") > 12)
    plain = F.when(year_first, F.concat_ws("-", F.substr(m, F.lit(1), F.lit(4)), F.substr(m, F.lit(6), F.lit(2)), F.substr(m, F.lit(9), F.lit(2)))).when(
        month_first, F.concat_ws("-", F.substr(m, F.lit(7), F.lit(4)), F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(4), F.lit(2)))
    ).otherwise(
        F.concat_ws("-", F.substr(m, F.lit(7), F.lit(4)), F.substr(m, F.lit(4), F.lit(2)), F.substr(m, F.lit(1), F.lit(2)))
    )

    def of(day: Column) -> Column:
        year = F.year(day)
        leap = (year % 4 == 0) & (year != 1900)
        # Common years in order: 1900 is 0, then three of every four from 1901 on.
        place = F.when(leap, F.floor((year - 1904) / 4)).otherwise(F.when(year == 1900, 0).otherwise(1 + (year - 1901) - F.floor((year - 1901) / 4)))

        def text(l: Column, r: Column) -> Column:
            back = F.when(leap, 1904 + 4 * l).otherwise(F.when(l == 0, 1900).otherwise(1901 + (l - 1) + F.floor((l - 1) / 3)))
            new = F.date_add(F.make_date(back.cast("int"), F.lit(1), F.lit(1)), r.cast("int"))
            return F.when(year_first, F.date_format(new, "yyyyMMdd")).when(month_first, F.date_format(new, "MMddyyyy")).otherwise(F.date_format(new, "ddMMyyyy"))

        sizes = (F.when(leap, F.lit(49)).otherwise(F.lit(151)), F.when(leap, F.lit(366)).otherwise(F.lit(365)))
        return F.when(day.isNull(), m).otherwise(refill(m, permute_pair(place, F.dayofyear(day) - 1, sizes, "date", key, text)))

    return let(plain.try_cast("date"), of)


def _email(m: Column, key: str) -> Column:
    """Name permuted; of the host, everything but the last two labels."""
    name, host = F.split_part(m, F.lit("@"), F.lit(1)), F.split_part(m, F.lit("@"), F.lit(2))
    kept = F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)
    front = F.substr(host, F.lit(1), F.char_length(host) - F.char_length(kept))
    return F.concat(permute_text(name, "email", key), F.lit("@"), permute_text(front, "host", key), kept)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    replace: Callable[[Column, str], Column]


KINDS = (
    Kind("email", EMAIL, _email),
    Kind("iban", IBAN, _iban),
    Kind("access_key", ACCESS_KEY, lambda m, key: F.concat(F.lit("AKIA"), permute_text(F.substr(m, F.lit(5), F.lit(16)), "access", key))),
    Kind("hex_key", HEX, lambda m, key: permute_text(m, "hex", key, hexadecimal=True)),
    Kind("ip", IP, _ip),
    Kind("date", DATE, _date),
    Kind("ssn", SSN, _ssn),
    Kind("phone", PHONE, _phone),
    Kind("international", INTERNATIONAL, _international),
    Kind("card", CARD, _card),
)


@functools.cache
def _own_key(application: str) -> str:
    return secrets.token_hex(32)


def session_key(spark: SparkSession) -> str:
    """The secret of the session's settings; a session without one gets a key of its own, which ends with it.

    Values stay linked across runs only under a key that is set. It is nowhere in the source, so pseudonyms cannot be undone
    by those who have the code.
    """
    return spark.conf.get(KEY_SETTING, None) or _own_key(spark.sparkContext.applicationId)


def pseudonymise(docs: DataFrame, key: str | None = None, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """`docs` with `text` rewritten, and `n_<kind>` (long) for each kind and `n_found` (long) added.

    One row-wise projection, no shuffle. Texts without a digit and without an @ pass
    untouched, as do null and empty texts (nothing found). Matches are taken from
    left to right without overlap. A value that only looks like its kind (a wrong IBAN, the 31st of February)
    stays as it is; a long number with a wrong check digit counts as an account number and gets a wrong one again. Columns of
    `docs` that carry such a name give way, all others stay. Without `key` that of the session holds, see `session_key`.
    """
    key = key or session_key(docs.sparkSession)
    listed = fresh_name("found", docs)
    any_kind = "|".join(f"(?:{k.pattern})" for k in kinds)
    added = [f"n_{k.name}" for k in kinds] + ["n_found"]
    kept = [c for c in docs.columns if c not in added]
    body = F.col(text)
    found = F.when(body.rlike("[0-9@]"), F.regexp_extract_all(body, F.lit(any_kind), F.lit(0)))
    named = F.transform(found, lambda m: F.struct(m.alias("m"), _kind_of(m, kinds).alias("k")))
    frame = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(listed, F.coalesce(named, F.array().cast("array<struct<m:string,k:int>>")))

    def replaced(e: Column) -> Column:
        out = e["m"]
        for i, kind in enumerate(kinds):
            out = F.when(e["k"] == i, kind.replace(e["m"], key)).otherwise(out)
        return out

    between = F.split(body, any_kind)
    rebuilt = F.array_join(
        F.flatten(F.zip_with(between, F.transform(listed, replaced), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), ""
    )
    new = F.when(F.size(listed) == 0, body).otherwise(rebuilt)
    count_of = lambda i: F.size(F.filter(listed, lambda e: e["k"] == i)).cast("long")
    counts = {f"n_{k.name}": count_of(i) for i, k in enumerate(kinds)}
    return frame.withColumns({text: new, **counts, "n_found": F.size(listed).cast("long")}).drop(listed)


def _kind_of(m: Column, kinds: tuple[Kind, ...]) -> Column:
    """The first kind whose pattern takes the whole match."""
    out = F.lit(len(kinds) - 1)
    for i in reversed(range(len(kinds))):
        out = F.when(m.rlike(f"^(?:{kinds[i].pattern})$"), i).otherwise(out)
    return out
