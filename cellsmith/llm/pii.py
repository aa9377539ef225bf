"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Candidates are found by one pattern, then validated: card numbers by their Luhn
digit, IBANs modulo 97, IPv4 octets, calendar dates from 1800 to 2199, US social
security numbers by their number ranges, telephone numbers by their shape, e-mail
addresses, and secrets (access keys, hexadecimal digests of 32 digits or more in either
case, all after ``password=`` up to white space or a quote). IBANs may be in groups of
four, where the length is the country's; their pseudonym is the same. Valid
ones are replaced by a keyed permutation of their own format, so equal values stay
equal in all documents, and different values of a format stay different:

* characters: a Feistel network over the string's halves in which each round
  shifts every letter and digit of one half within its kind (digit, lower case,
  upper case; for digests hexadecimal digit) by a stream that SHA-256 draws from
  the key, the round and the other half; signs keep their places;
* ranges: a Feistel network over (x, y) with x < a and y < b, where a * b is
  exactly the number of valid values (65536 * 65536 addresses, 189 * 773 = 146097
  days of 400 years, 898 * 989901 social security numbers).

Check digits are computed anew. Candidates that fail their test stay as they are; a row
of numbers ends before a date, address, social security or telephone number, and where
it is no card as a whole, cards in their usual groupings are looked for at every number.
A date with slashes is read month first unless its first number is over 12.

Defined cases: null texts stay null; texts without a digit, ``@`` and ``=`` are
passed through; repeated rows come out alike; an empty table gives an empty
result; other columns are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\1[0-9]{4})(?![0-9])"
_IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_LOCAL = r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
_DIGEST = r"(?=[0-9]*+[A-Fa-f])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9])"
#: Lengths of the countries' IBANs, by which those in groups of four are told from what follows.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_GROUPED = "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: [0-9A-Z]{{4}}){{{n // 4 - 1}}}" + (f" [0-9A-Z]{{{n % 4}}}" if n % 4 else "")
    for n, c in IBAN_LENGTHS.items())
#: Groupings in which a card number is looked for among other numbers.
CARD_SHAPES = (r"[0-9]{13,19}", r"[0-9]{4}(?:[ -][0-9]{4}){3}", r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}",
               r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}", r"[0-9]{4}(?:[ -][0-9]{3}){3}")
#: What begins a value of its own: a row of numbers ends before it.
_STRICT = "|".join((_DATE.replace(r"([/.])[0-9]{2}\1", r"(?:/[0-9]{2}/|\.[0-9]{2}\.)"), _IP, _SSN, _LOCAL, _DIGEST))
_AT = r"[A-Za-z0-9._%+-]++@"
#: One alternative a kind; a card's is a whole row of numbers, in which cards are looked for. Runs
#: are entered at their start only and not given back, so a long run of letters or digits costs its
#: length once.
PATTERNS = {
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?<=[Pp]assword=)[^\s\"']++",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "digest": r"(?<![A-Za-z0-9])" + _DIGEST,
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}|" + _GROUPED + ")(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])" + _IP,
    "date": r"(?<![0-9/.-])" + _DATE,
    "ssn": r"(?<![0-9-])" + _SSN,
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?" + _LOCAL
             + r"|\+[0-9]{1,3}(?:(?:[ .-](?!" + "|".join((_STRICT, *(x + "(?![0-9])" for x in CARD_SHAPES)))
             + r"))?[0-9]{2,4}){3,5}(?![0-9])",
    "card": rf"(?<![0-9])(?=(?:[0-9][ -]?){{13}})[0-9]++(?:(?:-(?!{_STRICT})| (?!{_STRICT}|{_AT}))[0-9]++)*+",
}
_ANY = "(" + "|".join(p.replace(r"\1", r"\2") for p in PATTERNS.values()) + ")"
_HEX = "0123456789abcdef"


def _hash(key: str, *parts: Column | str | int) -> Column:
    """A keyed number below 2**32."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in (key, *parts)]
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256), 1, 8), 16, 10).cast("long")


def _char(s: Column, i: Column) -> Column:
    return F.substring(s, i, F.lit(1))


def _chars(s: Column, each) -> Column:
    """``each`` of the character and its 1-based place, joined; empty for an empty string."""
    made = F.transform(F.split(s, ""), lambda c, i: each(c, i + 1))
    return F.when(F.length(s) > 0, F.array_join(made, "")).otherwise(F.lit(""))


def _shifted(half: Column, other: Column, key: str, tweak: str, r: Column, hexadecimal: bool) -> Column:
    def one(c: Column, i: Column, other: Column) -> Column:
        k = _hash(key, tweak, r, i, other)
        if hexadecimal:
            at = F.instr(F.lit(_HEX), F.lower(c)) - 1
            return F.when(at >= 0, F.substring(F.lit(_HEX), ((at + k) % 16 + 1).cast("int"), F.lit(1))).otherwise(c)
        code = F.ascii(c)
        move = lambda low, n: F.char((code - low + k) % n + low)
        return F.when(code.between(48, 57), move(48, 10)).when(code.between(97, 122), move(97, 26)) \
            .when(code.between(65, 90), move(65, 26)).otherwise(c)

    # a long half goes into every character's hash by its own hash, so that the cost stays linear
    drawn = F.when(F.length(other) > 64, F.sha2(other, 256)).otherwise(other)
    return F.transform(F.array(drawn), lambda o: _chars(half, lambda c, i: one(c, i, o)))[0]


def permuted(s: Column, key: str, tweak: str, hexadecimal: bool = False) -> Column:
    """The string's pseudonym: same length, each character of the same kind."""
    a = (F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), a).alias("l"), F.substring(s, a + 1, F.length(s)).alias("r"))

    def step(st: Column, r: Column) -> Column:
        odd = r % 2 == 1
        left = F.when(odd, st["l"]).otherwise(_shifted(st["l"], st["r"], key, tweak, r, hexadecimal))
        right = F.when(odd, _shifted(st["r"], st["l"], key, tweak, r, hexadecimal)).otherwise(st["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    return F.aggregate(rounds, start, step, lambda st: F.concat(st["l"], st["r"]))


def permuted_pair(x: Column, y: Column, a: int, b: int, key: str, tweak: str) -> Column:
    """(x, y) permuted within x < a, y < b; a struct of longs."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

    def step(st: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(F.when(odd, (st["x"] + _hash(key, tweak, r, st["y"])) % a).otherwise(st["x"]).alias("x"),
                        F.when(odd, st["y"]).otherwise((st["y"] + _hash(key, tweak, r, st["x"])) % b).alias("y"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)]), start, step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refilled(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    def one(c: Column, i: Column) -> Column:
        k = F.length(_digits(F.substring(m, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), _char(digits, k)).otherwise(c)

    return _chars(m, one)


def luhn(d: Column) -> Column:
    """Luhn sum of a digit string modulo 10."""
    n = F.length(d)

    def add(t: Column, i: Column) -> Column:
        x = _char(d, n - i + 1).cast("int")
        return t + F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def mod97(s: Column) -> Column:
    """The string, letters read as 10 to 35, as a number modulo 97."""
    def add(t: Column, i: Column) -> Column:
        code = F.ascii(_char(s, i))
        return F.when(code <= 57, (t * 10 + code - 48) % 97).otherwise((t * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), add)


def _email(m: Column, key: str) -> Column:
    head = F.regexp_replace(m, r"\.[^.]*$", "")
    return F.concat(permuted(head, key, "email"), F.substring(m, F.length(head) + 1, F.length(m)))


def _secret(m: Column, key: str) -> Column:
    keep = F.when(m.startswith("AKIA"), 4).otherwise(0)
    return F.concat(F.substring(m, F.lit(1), keep), permuted(F.substring(m, keep + 1, F.length(m)), key, "secret"))


def _iban(m: Column, key: str) -> Column:
    whole = F.replace(m, F.lit(" "), F.lit(""))
    country, rest = F.substring(m, 1, 2), F.substring(whole, F.lit(5), F.length(whole))
    new = permuted(rest, key, "iban")
    check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    valid = mod97(F.concat(rest, F.substring(m, 1, 4))) == 1

    def shown(made: Column) -> Column:
        place = lambda i: F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(" "), F.lit("")))
        return _chars(m, lambda c, i: F.when(c == " ", c).otherwise(_char(made, place(i))))

    return F.when(valid, F.transform(F.array(F.concat(country, check, new)), shown)[0])


def _digest(m: Column, key: str) -> Column:
    new = permuted(F.lower(m), key, "digest", True)
    return F.when(m.rlike("[a-f]"), new).otherwise(F.upper(new))


def _ip(m: Column, key: str) -> Column:
    o = [F.split(m, r"\.")[i].cast("long") for i in range(4)]
    valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
    p = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
    text = F.transform(F.array(p), lambda q: F.concat_ws(".", *[
        v.cast("string") for v in (F.floor(q["x"] / 256), q["x"] % 256, F.floor(q["y"] / 256), q["y"] % 256)]))[0]
    return F.when(valid, text)


def _date(m: Column, key: str) -> Column:
    iso = m.rlike("^[0-9]{4}")
    a, b = F.substring(m, 1, 2), F.substring(m, 4, 2)
    sign = F.substring(m, 3, 1)
    day_first = (sign == ".") | (F.when(iso, 0).otherwise(a.try_cast("int")) > 12)
    year = F.substring(m, 7, 4)
    plain = F.when(iso, m).when(day_first, F.concat_ws("-", year, b, a)).otherwise(F.concat_ws("-", year, a, b))
    n = F.datediff(plain.try_cast("date"), F.lit("1800-01-01").cast("date"))
    p = permuted_pair(F.floor(n / 773), n % 773, 189, 773, key, "date")
    made = F.transform(F.array(p), lambda q: F.date_add(F.lit("1800-01-01").cast("date"),
                                                        (q["x"] * 773 + q["y"]).cast("int")).cast("string"))[0]

    def shown(d: Column) -> Column:
        y, mo, da = F.substring(d, 1, 4), F.substring(d, 6, 2), F.substring(d, 9, 2)
        return F.when(iso, d).when(day_first, F.concat(da, sign, mo, sign, y)).otherwise(F.concat(mo, sign, da, sign, y))

    return F.when(n.between(0, 146096), F.transform(F.array(made), shown)[0])


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, i, n).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    x = F.when(area > 666, area - 2).otherwise(area - 1)
    p = permuted_pair(x, (group - 1) * 9999 + serial - 1, 898, 989901, key, "ssn")

    def shown(q: Column) -> Column:
        number = F.when(q["x"] >= 665, q["x"] + 2).otherwise(q["x"] + 1)
        pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.concat_ws("-", pad(number, 3), pad(F.floor(q["y"] / 9999) + 1, 2), pad(q["y"] % 9999 + 1, 4))

    return F.when(valid, F.transform(F.array(p), shown)[0])


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = permuted(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")

    def shown(b: Column) -> Column:
        return _refilled(m, F.concat(b, ((10 - luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))

    return F.when((luhn(d) == 0) & F.length(d).between(13, 19), F.transform(F.array(body), shown)[0])


def _cards(m: Column, key: str) -> Column:
    """(text, n) of a row of numbers that is no card as a whole, with the cards in it replaced; null
    without one. A card is looked for at every number, those with an issuer's first digit first."""
    at = [F.regexp_extract_all(m, F.lit(rf"(?<![0-9])(?=({x})(?![0-9]))[0-9]++"), F.lit(1)) for x in CARD_SHAPES]
    valid = F.filter(F.array_distinct(F.concat(*at)), lambda v: luhn(_digits(v)) == 0)
    known = lambda v: v.rlike("^[3-6]")
    ordered = F.concat(F.filter(valid, known), F.filter(valid, lambda v: ~known(v)))

    def step(st: Column, v: Column) -> Column:
        here = F.concat(F.lit("(?<![0-9])"), v, F.lit("(?![0-9])"))
        return F.struct(F.regexp_replace(st["text"], here, _card(v, key)).alias("text"),
                        (st["n"] + F.size(F.regexp_extract_all(st["text"], here, F.lit(0)))).alias("n"))

    made = F.aggregate(ordered, F.struct(m.alias("text"), F.lit(0).alias("n")), step)
    return F.transform(F.array(made), lambda x: F.when(x["n"] > 0, x))[0]


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    code = F.greatest(F.length(d) - 10, F.lit(0))
    new = F.concat(F.substring(d, F.lit(1), code), permuted(F.substring(d, code + 1, F.length(d)), key, "phone"))
    return F.transform(F.array(new), lambda x: _refilled(m, x))[0]


_MASKS = {"email": _email, "secret": _secret, "digest": _digest, "iban": _iban,
          "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(m: Column, key: str) -> Column:
    """(text, n): the pseudonym of a found value and the number of values in it, or null
    where it fails its kind's test.

    What fails as one kind may still be another. A row of numbers that is no card is
    searched for cards in it.
    """
    whole = lambda p: m.rlike("^(?:" + p.replace("(?<=[Pp]assword=)", "") + ")$")
    secret = m.startswith("AKIA") & (F.length(m) == 20)
    tests = {k: whole(p) for k, p in PATTERNS.items() if k != "secret"} | {"secret": secret}
    tried = [F.when(tests[k], _MASKS[k](m, key)) for k in PATTERNS]
    return F.coalesce(_one(F.coalesce(*tried)), F.when(tests["card"] | (tests["iban"] & m.contains(" ")), _cards(m, key)))


def _one(made: Column) -> Column:
    return F.transform(F.array(made), lambda x: F.when(x.isNotNull(), F.struct(x.alias("text"), F.lit(1).alias("n"))))[0]


def pseudonymised(docs: DataFrame, *, key: str, text_col: str = "text") -> DataFrame:
    """(row, n_replaced, text): the input row, how many values were replaced, the new text."""
    df = docs.select(F.struct("*").alias("row"))
    t = F.col(f"row.`{text_col}`")
    some = t.rlike("[0-9@=]")
    found = F.when(some, F.regexp_extract_all(t, F.lit(_ANY), F.lit(0)))
    df = df.select("row", found.alias("found"))
    df = df.select("row", "found", F.when(F.size("found") > 0, F.split(t, _ANY, -1)).alias("parts"))
    after_password = lambda i: F.get("parts", i).rlike("[Pp]assword=$")
    # a match after password= is a secret whatever it looks like
    new = F.transform("found", lambda m, i: F.when(after_password(i), _one(_secret(m, key))).otherwise(pseudonym(m, key)))
    df = df.select("row", "found", "parts", F.when(F.size("found") > 0, new).alias("new"))
    filled = F.transform("parts", lambda p, i: F.concat(
        p, F.coalesce(F.get("new", i)["text"], F.get("found", i), F.lit(""))))
    n = F.aggregate("new", F.lit(0), lambda t, x: t + F.coalesce(x["n"], F.lit(0)))
    return df.select("row", F.when(F.size("new") > 0, n).otherwise(0).cast("long").alias("n_replaced"),
                     F.when(F.size("parts") > 0, F.array_join(filled, "")).otherwise(t).alias("text"))


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced, all columns."""
    out = pseudonymised(docs, key=key, text_col=text_col)
    return out.select(*[(F.col("text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
