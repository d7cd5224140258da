"""Format-preserving pseudonyms for private data, in Spark's own expressions only.

Candidates are found by pattern and validated: payment cards by length and Luhn digit, IBANs (also in groups) by their
country's length and remainder of 97, dates by the calendar, social security numbers and IPv4 addresses by their parts'
ranges, international telephone numbers by their number of digits; national telephone numbers by form.
A valid value becomes a pair (a, b) in a product of two ranges, a keyed alternating Feistel network permutes the pairs
(a += f(b) mod A, b += f(a) mod B, so that it is a bijection of any such product), and the result is written back into
the value's own layout; check digits are computed anew. A date stays within its 20 years and its layout, with or without
leading zeros; a slash date is month first where it can be and day first else, and stays so. What is no number has no
such product: the local part of an e-mail address, access keys, tokens, the body of a private key and the digits of an
IPv6 address (of four groups or more, or two before its gap) are replaced by keyed characters, as many as there were. The same value gets the same pseudonym in every
document, whatever its separators.

Text is cut at the matches and joined again with their pseudonyms, so the work is linear in its length. No shuffle.

Defined results: a null text stays null with 0 replaced, an empty one stays empty; what fails validation stays; dates
outside 1700 to 2099 stay; repeated rows get a row each; other columns are kept, but for one that is named like the
count, which the count replaces; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: The length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
BY_COUNTRY = "|".join(f"(?:{'|'.join(c for c, m in IBAN_LENGTHS.items() if m == n)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n in sorted(set(IBAN_LENGTHS.values())))
#: How each kind is written. Every pattern is linear: each part is bounded or cannot be entered halfway.
PATTERNS = {
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s:,]{1,8000}+-----END [A-Z ]{0,40}PRIVATE KEY-----",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){1,8}",
    "access_key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "token": r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{20,255}+|xox[abprs]-[A-Za-z0-9-]{10,255}+|sk[-_](?:live_|test_|proj-)?[A-Za-z0-9]{16,255}+|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,2000}+\.[A-Za-z0-9_-]{8,2000}+\.[A-Za-z0-9_-]{8,2000}+)",
    "iban": rf"(?<![A-Za-z0-9])(?:{BY_COUNTRY}|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}})(?![A-Za-z0-9])",
    "iso_date": r"(?<![0-9.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
    "dot_date": r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "slash_date": r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9]|/[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "world_phone": r"(?<![0-9])\+[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,5}\)|[0-9]{2,14}+)){1,6}+(?![0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,6}|[0-9A-Fa-f]{1,4}:(?::[0-9A-Fa-f]{1,4}){3,6})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}|[0-9]{13,19})(?![0-9])",
}
ANY = "|".join(p.replace(r"\1", "[ -]").replace(r"\2", "[ -]").replace("([ -])", "[ -]") for p in PATTERNS.values())
#: What every value holds one of.
MAY_HOLD = r"[0-9@]|AKIA|PRIVATE KEY|gh[pousr]_|xox[abprs]-|sk[-_]|AIza|eyJ|::"
#: Dates from 1700 on are permuted among YEARS years; valid social security areas, groups and serials.
FIRST_YEAR, LAST_YEAR, YEARS = 1700, 2099, 20
#: Places that do not exist, such as a 30 February, are walked over, so often at most.
WALK = 12
SSN_A, SSN_B = 898, 99 * 9999


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def number(c: Column) -> Column:
    return c.try_cast("bigint")


def keyed(key: str, kind: str, *parts: Column) -> Column:
    """A hexadecimal keyed digest."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]), 256)
    return F.sha2(F.concat_ws("|", F.lit(key), inner), 256)


def feistel(key: str, kind: str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """struct(a, b): a keyed permutation of the pairs 0 <= a < size_a, 0 <= b < size_b."""

    def f(i: Column, x: Column) -> Column:
        return F.conv(F.substring(keyed(key, kind, size_a, size_b, i, x), 1, 14), 16, 10).cast("bigint")

    def one(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        na = F.when(even, F.pmod(s["a"] + f(i, s["b"]), size_a)).otherwise(s["a"])
        nb = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + f(i, s["a"]), size_b))
        return F.struct(na.alias("a"), nb.alias("b"))

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


def permuted_digits(key: str, kind: str, d: Column) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    n = F.length(d)
    left = F.floor(n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("bigint")
    s = feistel(key, kind, number(F.substr(d, F.lit(1), left)), number(F.substr(d, left + 1)), size(left), size(n - left))
    return F.transform(F.array(s), lambda x: F.concat(F.lpad(x["a"].cast("string"), left, "0"), F.lpad(x["b"].cast("string"), n - left, "0")))[0]


def luhn_sum(d: Column) -> Column:
    """Sum over the digits, every second one from the right, the last not, doubled and its digits added."""
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        x = F.substr(d, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def mod97(text: Column) -> Column:
    """The remainder of 97 of text with letters read as 10 to 35."""
    chars = F.sequence(F.lit(1), F.length(text))

    def add(r: Column, i: Column) -> Column:
        c = F.ascii(F.substr(text, i, F.lit(1)))
        return F.when(c >= 65, (r * 100 + c - 55) % 97).otherwise((r * 10 + c - 48) % 97)

    return F.aggregate(chars, F.lit(0), add)


def laid_out(like: Column, d: Column, kind: str = "0-9") -> Column:
    """like, with its characters of a kind replaced by d's in order."""
    places = F.sequence(F.lit(1), F.length(like))

    def at(i: Column) -> Column:
        c = F.substr(like, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substr(like, F.lit(1), i), f"[^{kind}]", ""))
        return F.when(c.rlike(f"[{kind}]"), F.substr(d, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(places, at), "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def letters(hexadecimal: Column, n: Column, upper: bool) -> Column:
    """n characters made from a digest: letters, or capitals and digits."""
    long = F.substr(F.repeat(hexadecimal, (n / 64 + 1).cast("int")), F.lit(1), n)
    return F.translate(long, "0123456789abcdef", "GHJKLMNPQR234567") if upper else F.translate(long, "0123456789abcdef", "ghijklmnopqrstuv")


def pseudonym(key: str, m: Column) -> Column:
    """What takes the place of the match m; m itself where it is not valid."""

    def is_a(*kinds: str) -> Column:
        return m.rlike("^(?:" + "|".join(PATTERNS[k] for k in kinds) + ")$")

    def email() -> Column:
        local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
        return F.concat(letters(keyed(key, "email", F.lower(m)), F.length(local), False), F.lit("@"), domain)

    def access_key() -> Column:
        return F.concat(F.lit("AKIA"), letters(keyed(key, "access_key", m), F.lit(16), True))

    def token() -> Column:
        return F.concat(F.substring(m, 1, 4), letters(keyed(key, "token", m), F.length(m) - 4, False))

    def private_key() -> Column:
        head, tail = F.regexp_extract(m, "^-----BEGIN [A-Z ]*-----", 0), F.regexp_extract(m, "-----END [A-Z ]*-----$", 0)
        return F.concat(head, letters(keyed(key, "private_key", m), F.length(m) - F.length(head) - F.length(tail), False), tail)

    def iban() -> Column:
        country, check, rest = F.substring(m, 1, 2), F.substring(m, 3, 2), F.substr(m, F.lit(5))
        bare = lambda x: F.replace(x, F.lit(" "), F.lit(""))
        valid = mod97(F.concat(bare(rest), country, check)) == 1
        own = F.when(F.length(digits(rest)) >= 2, laid_out(rest, permuted_digits(key, "iban", digits(rest)))).otherwise(rest)
        made = let(own, lambda x: F.concat(country, F.lpad((98 - mod97(F.concat(bare(x), country, F.lit("00")))).cast("string"), 2, "0"), x))
        return F.when(valid, made).otherwise(m)

    def date(y: Column, month: Column, day: Column, write, from_day: int = 1) -> Column:
        """The date moved among those of its years whose day and month are as long; write(year, month, day as text)."""
        y_, m_, d_ = number(y), number(month), number(day)
        both = F.length(month) + F.length(day) == 4
        tens = lambda x: (F.length(x) == 2) & ~F.startswith(x, F.lit("0"))
        low = lambda x: F.when(~both & tens(x), 10).otherwise(1)
        high = lambda x, most: F.when(both | tens(x), most).otherwise(9)
        first_month, first_day, last_day = low(month), F.greatest(low(day), F.lit(from_day)), high(day, 31)
        months = high(month, 12) - first_month + 1
        block = F.floor((y_ - FIRST_YEAR) / YEARS)
        pack = F.struct(
            (d_ - first_day).alias("a"), ((y_ - FIRST_YEAR - block * YEARS) * months + m_ - first_month).alias("b"), (last_day - first_day + 1).cast("bigint").alias("na"), (months * YEARS).cast("bigint").alias("nb"),
            first_day.alias("d0"), first_month.alias("m0"), months.cast("bigint").alias("months"), (FIRST_YEAR + block * YEARS).alias("y0"),
        )
        real = lambda yy, mm, dd: (dd >= 1) & (dd <= F.when(mm == 2, F.when((yy % 4 == 0) & ((yy % 100 != 0) | (yy % 400 == 0)), 29).otherwise(28)).when(mm.isin(4, 6, 9, 11), 30).otherwise(31))
        of = lambda x, s: (x["y0"] + F.floor(s["b"] / x["months"]), x["m0"] + s["b"] % x["months"], x["d0"] + s["a"])

        def walk(x: Column) -> Column:
            def on(s: Column, i: Column) -> Column:
                step = feistel(key, "date", s["a"], s["b"], x["na"], x["nb"])
                return F.when((i > 0) & real(*of(x, s)), s).otherwise(step)

            start = F.struct(x["a"].cast("bigint").alias("a"), x["b"].cast("bigint").alias("b"))
            return let(F.aggregate(F.sequence(F.lit(0), F.lit(WALK - 1)), start, on), lambda s: shown(x, s))

        def shown(x: Column, s: Column) -> Column:
            yy, mm, dd = of(x, s)
            text = lambda v, like: F.lpad(v.cast("string"), F.length(like), "0")
            return F.when(real(yy, mm, dd), write(yy.cast("string"), text(mm, month), text(dd, day))).otherwise(m)

        valid = y_.between(FIRST_YEAR, LAST_YEAR) & m_.between(1, 12) & real(y_, m_, d_) & (d_ >= first_day) & (d_ <= last_day)
        return F.when(F.coalesce(valid, F.lit(False)), let(pack, walk)).otherwise(m)

    def iso_date() -> Column:
        return date(F.substring(m, 1, 4), F.substring(m, 6, 2), F.substring(m, 9, 2), lambda y, mo, d: F.concat_ws("-", y, mo, d))

    def dot_date() -> Column:
        p = F.split(m, "[.]")
        return date(p[2], p[1], p[0], lambda y, mo, d: F.concat_ws(".", d, mo, y))

    def slash_date() -> Column:
        p = F.split(m, "/")
        day_first = date(p[2], p[1], p[0], lambda y, mo, d: F.concat_ws("/", d, mo, y), 13)
        return F.when(number(p[0]) > 12, day_first).otherwise(date(p[2], p[0], p[1], lambda y, mo, d: F.concat_ws("/", mo, d, y)))

    def ssn() -> Column:
        area, group, serial = number(F.substring(m, 1, 3)), number(F.substring(m, 5, 2)), number(F.substring(m, 8, 4))
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        a, b = area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1
        s = feistel(key, "ssn", a, b, F.lit(SSN_A), F.lit(SSN_B))
        made = let(s, lambda x: F.format_string("%03d-%02d-%04d", x["a"] + F.when(x["a"] > 664, 2).otherwise(1), F.floor(x["b"] / 9999) + 1, x["b"] % 9999 + 1))
        return F.when(valid, made).otherwise(m)

    def phone() -> Column:
        d = digits(m)
        return laid_out(m, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), permuted_digits(key, "phone", F.right(d, F.lit(10)))))

    def world_phone() -> Column:
        d = digits(m)
        made = laid_out(m, F.concat(F.substring(d, 1, 2), permuted_digits(key, "world_phone", F.substr(d, F.lit(3)))))
        return F.when(F.length(d).between(8, 15), made).otherwise(m)

    def ip6() -> Column:
        return laid_out(m, keyed(key, "ip6", F.lower(m)), "0-9A-Fa-f")

    def ip() -> Column:
        p = F.transform(F.split(m, "[.]"), number)
        a, b = p[0] * 256 + p[1], p[2] * 256 + p[3]
        s = feistel(key, "ip", a, b, F.lit(65536), F.lit(65536))
        made = let(s, lambda x: F.concat_ws(".", F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256))
        return F.when(F.forall(p, lambda x: x < 256), made).otherwise(m)

    def card() -> Column:
        def of(d: Column) -> Column:
            body = permuted_digits(key, "card", F.substr(d, F.lit(1), F.length(d) - 1))
            full = let(body, lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))
            return F.when(F.length(d).between(13, 19) & (luhn_sum(d) % 10 == 0), laid_out(m, full)).otherwise(m)

        return let(digits(m), of)

    return (
        F.when(F.startswith(m, F.lit("-----BEGIN ")), private_key())
        .when(F.contains(m, F.lit("@")), email())
        .when(is_a("access_key"), access_key())
        .when(is_a("token"), token())
        .when(is_a("iban"), iban())
        .when(is_a("iso_date"), iso_date())
        .when(is_a("dot_date"), dot_date())
        .when(is_a("slash_date"), slash_date())
        .when(is_a("ssn"), ssn())
        .when(is_a("phone"), phone())
        .when(is_a("world_phone"), world_phone())
        .when(is_a("ip"), ip())
        .when(is_a("ip6"), ip6())
        .otherwise(card())
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_replaced", size_col: str | None = None) -> DataFrame:
    """docs with private data in text_col replaced; count_col: a further column with the number of replaced values; size_col: set to the text's characters, if there is such a column."""
    text = F.col(f"`{text_col}`")
    others = [F.col(f"`{c}`") for c in docs.columns]
    found = F.when(text.rlike(MAY_HOLD), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    step = docs.select(F.struct(*others).alias("_row"), text.alias("_t"), F.coalesce(found, F.array().cast("array<string>")).alias("_found"))
    step = step.withColumn("_new", F.transform("_found", lambda m: pseudonym(key, m)))
    pieces = F.split("_t", ANY, -1)
    joined = F.concat(F.array_join(F.flatten(F.zip_with(F.slice(pieces, F.lit(1), F.size("_new")), "_new", lambda p, n: F.array(p, n))), ""), F.element_at(pieces, -1))
    step = step.withColumn("_out", F.when(F.size("_found") > 0, joined).otherwise(F.col("_t")))
    n = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x)).cast("bigint")
    out = []
    for field in docs.schema.fields:
        if field.name == count_col:
            continue
        c = F.col(f"_row.`{field.name}`")
        if field.name == text_col:
            c = F.col("_out")
        elif field.name == size_col:
            c = F.length("_out").cast(field.dataType)
        out.append(c.alias(field.name))
    return step.select(*out, *([n.alias(count_col)] if count_col else []))
