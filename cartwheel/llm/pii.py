"""Format-preserving pseudonyms for personal data in texts, by keyed Feistel permutations.

What is found and validated is replaced, in its own format, by another value of that format:

* numbers: payment cards (Luhn), IBANs (modulo 97), US social security numbers (valid areas), phone
  numbers, IPv4 addresses (octets up to 255)
* dates that exist, of 1900 to 2099, as YYYY-MM-DD, DD/MM/YYYY, DD.MM.YYYY or DD-MM-YYYY
* e-mail addresses (the last label of the domain stays)
* keys: AKIA... access key ids, 32 to 64 hexadecimal digits of either case in quotes, and hexadecimal passwords

Area codes in brackets may begin with any digit, without brackets with 2 to 9. Of digit groups in a row that are no card as a
whole, those that make one are found, such as a card before its check code. What looks like an account, has
hexadecimal digits only and fails modulo 97 is taken as a key.

A Feistel network is a permutation whatever its round function is, so different values get different
pseudonyms, and under one key a value gets the same one in every document. The characters that may change
are taken out of the value, the halves of that sequence are shifted by each other's keyed SHA-256 in
``ROUNDS`` rounds (each place within its own alphabet), and the result is put back between the characters
that stay. Cards and IBANs get new check digits, so they stay valid. Addresses and dates are numbers in a
product of two ranges, over which the halves are shifted.

What fails its validation stays as it is, and a text without any find is returned unchanged. Built of
DataFrame functions only.

Defined results: null stays null with no finds, an empty text stays empty, each row is treated by itself,
and the documents' columns, whatever their names, keep their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import table

KEY = "cartwheel-demonstration-key"  # use a secret of your own
ROUNDS = 8

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"
LEADING, OTHER = "23456789", "01"  # first digits of area and exchange codes in use, and of others

FIRST_DAY = "1900-01-01"
DAYS = (250, 292)  # 73,000 days, up to 2099-11-12

# What values look like, in the order in which they are tried.
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}+@[A-Za-z0-9\-]{1,63}+(?:\.[A-Za-z0-9\-]{1,63}+){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex": r"(?<=[\"'])[0-9a-fA-F]{32,64}(?=[\"'])|(?<=password=)[0-9a-fA-F]{8,64}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![0-9])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.\-])[0-9]{2}\1(?:19|20)[0-9]{2})(?![0-9])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9\-])",
    "phone": r"(?:(?<![0-9A-Za-z])\+[0-9]{1,3}[ .\-]?)?(?<![0-9])(?:\([0-9]{3}\) ?[0-9]{3}|[2-9][0-9]{2}[ .\-][2-9][0-9]{2})[ .\-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .\-][0-9]{2,4}){2,5}(?![0-9])",
    # a fifth group only where it is not the beginning of another number
    "card": r"(?<![0-9A-Za-z])[3-6][0-9]{3}(?:(?:[ \-]?[0-9]{2,4}){4}[0-9](?![0-9A-Za-z]|[ /.\-][0-9])|(?:[ \-]?[0-9]{2,4}){2,3}[0-9](?![0-9A-Za-z])|(?:[ \-]?[0-9]{2,4}){4}[0-9](?![0-9A-Za-z]))",
}


def _either(patterns: dict[str, str]) -> str:
    """All patterns as one; the reference back in dates counts the groups before it, of which there are none."""
    return "|".join(f"(?:{pattern})" for pattern in patterns.values())


ANY = _either(PATTERNS)
# A part that every find has, which is quicker to look for.
MAYBE = r"[0-9]{3}|@|[0-9][ .\-][0-9]|AKIA|password=|[\"'][0-9a-fA-F]{8}|[A-Z]{2}[0-9]{2}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later columns read, instead of computing it again in each of them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _number(key: str, *parts: Column | str, modulus: Column | int) -> Column:
    """A number below ``modulus``, from the first 60 bits of a keyed SHA-256."""
    text = F.concat_ws("|", F.lit(key), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint"), modulus)


def _rounds() -> Column:
    return F.array(*[F.lit(number) for number in range(ROUNDS)])


def _permuted_number(value: Column, low: int, high: int, key: str, kind: str) -> Column:
    """A permutation of the numbers below ``low * high``."""
    start = F.struct((value / low).cast("bigint").alias("a"), F.pmod(value, F.lit(low)).alias("b"))

    def step(state: Column, number: Column) -> Column:
        a, b = state["a"], state["b"]
        even = F.pmod(a + _number(key, kind, number, b, modulus=high), F.lit(high))
        odd = F.pmod(b + _number(key, kind, number, a, modulus=low), F.lit(low))
        first = number % 2 == 0
        return F.struct(F.when(first, even).otherwise(a).alias("a"), F.when(first, b).otherwise(odd).alias("b"))

    done = F.aggregate(_rounds(), start, step)
    return done["a"] * low + done["b"]


def _shifted(half: Column, by: Column, number: Column, key: str, kind: str) -> Column:
    """Each place of ``half`` moved within its alphabet by a keyed number of the other half."""
    other = F.array_join(F.transform(by, lambda place: place["value"].cast("string")), ",")

    def moved(place: Column, at: Column, joined: Column) -> Column:
        size = F.length(place["alphabet"]).cast("bigint")
        shift = _number(key, kind, number, at, joined, modulus=size)
        return F.struct(place["alphabet"].alias("alphabet"), F.pmod(place["value"] + shift, size).alias("value"))

    return _let(other, lambda joined: F.transform(half, lambda place, at: moved(place, at, joined)))


def _permuted_places(places: Column, key: str, kind: str) -> Column:
    """A permutation of all sequences over these alphabets."""
    middle = F.floor(F.size(places) / 2).cast("int")
    start = F.struct(
        F.slice(places, F.lit(1), middle).alias("a"), F.slice(places, middle + 1, F.size(places) - middle).alias("b")
    )

    def step(state: Column, number: Column) -> Column:
        a, b = state["a"], state["b"]
        first = number % 2 == 0
        return F.struct(
            F.when(first, _shifted(a, b, number, key, kind)).otherwise(a).alias("a"),
            F.when(first, b).otherwise(_shifted(b, a, number, key, kind)).alias("b"),
        )

    done = F.aggregate(_rounds(), start, step)
    return F.concat(done["a"], done["b"])


def _permuted_text(letters: Column, alphabets: Column, key: str, kind: str) -> Column:
    """``letters`` with those that have an alphabet permuted; an empty alphabet keeps the letter."""
    marked = F.zip_with(letters, alphabets, lambda letter, alphabet: F.struct(letter.alias("letter"), alphabet.alias("alphabet")))
    return _let(marked, lambda places: _permuted_marked(places, key, kind))


def _permuted_marked(marked: Column, key: str, kind: str) -> Column:
    free = F.filter(marked, lambda place: place["alphabet"] != "")
    # capital letters of mixed text move with the small ones, so that case does not part equal values
    places = F.transform(
        free,
        lambda place: F.struct(
            place["alphabet"].alias("alphabet"),
            (F.instr(place["alphabet"], _as_in(place["alphabet"], place["letter"])) - 1).cast("bigint").alias("value"),
        ),
    )
    moved = F.transform(
        _permuted_places(places, key, kind), lambda place: F.substring(place["alphabet"], place["value"].cast("int") + 1, F.lit(1))
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"), moved.alias("moved"))

    def put(state: Column, place: Column) -> Column:
        fixed = place["alphabet"] == ""
        letter = F.get(state["moved"], state["used"])
        capital = (place["alphabet"] == LOWER) & place["letter"].between("A", "Z")
        new = F.when(fixed, place["letter"]).when(capital, F.upper(letter)).otherwise(letter)
        used = state["used"] + F.when(fixed, 0).otherwise(1)
        return F.struct(F.concat(state["text"], new).alias("text"), used.alias("used"), state["moved"].alias("moved"))

    return F.aggregate(marked, start, put, lambda state: state["text"])


def _as_in(alphabet: Column, letter: Column) -> Column:
    return F.when(alphabet == LOWER, F.lower(letter)).otherwise(letter)


def _letters(value: Column) -> Column:
    return F.split(value, "")


def _by_class(letters: Column) -> Column:
    """An alphabet for each digit and letter; small and capital letters share theirs."""

    def alphabet(letter: Column) -> Column:
        return F.when(letter.between("0", "9"), DIGITS).when(F.lower(letter).between("a", "z"), LOWER).otherwise("")

    return F.transform(letters, alphabet)


def _only(letters: Column, alphabet: str, *, first: Column | int = 0, last: Column | int = 1 << 30) -> Column:
    """This alphabet for the letters in it from place ``first`` up to ``last``."""
    return F.transform(
        letters, lambda letter, at: F.when((at >= first) & (at < last) & (F.instr(F.lit(alphabet), letter) > 0), alphabet).otherwise("")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column, doubled: int) -> Column:
    """The Luhn sum; from the right, each second digit counts double, beginning with place ``doubled``."""

    def weight(digit: Column, at: Column) -> Column:
        number = digit.cast("int")
        twice = F.when(number >= 5, 2 * number - 9).otherwise(2 * number)
        return F.when(at % 2 == doubled, twice).otherwise(number)

    return F.aggregate(F.transform(F.reverse(_letters(digits)), weight), F.lit(0), lambda total, number: total + number)


def _mod_97(text: Column) -> Column:
    """The remainder of a number in which letters stand for 10 to 35."""
    def step(rest: Column, letter: Column) -> Column:
        value = F.conv(letter, 36, 10).cast("int")
        return F.when(value >= 10, rest * 100 + value).otherwise(rest * 10 + value) % 97

    return F.aggregate(_letters(text), F.lit(0), step)


def _card_within(value: Column) -> Column:
    """Begin and end of the first whole groups, the longest of them, that make a valid card; null if there are none."""
    size = F.length(value)

    def ends(begin: Column) -> Column:
        last = F.sequence(size, F.least(size, begin + 12), F.lit(-1))
        return F.transform(last, lambda end: F.struct(begin.alias("begin"), end.alias("end")))

    def digit(at: Column) -> Column:
        return F.substring(value, at, F.lit(1)).rlike("[0-9]")

    def valid(span: Column) -> Column:
        begin, end = span["begin"], span["end"]
        alone = ((begin == 1) | ~digit(begin - 1)) & ((end == size) | ~digit(end + 1)) & digit(end)
        part = F.substring(value, begin, end - begin + 1)
        digits = _digits(part)
        fits = part.rlike("^[3-6][0-9]{3}") & F.length(digits).between(13, 19)
        return F.when(alone, F.when(fits, _luhn(digits, 1) % 10 == 0).otherwise(False)).otherwise(False)

    return F.get(F.filter(F.flatten(F.transform(F.sequence(F.lit(1), size), ends)), valid), F.lit(0))


def _card(value: Column, key: str) -> Column:
    """The card in the find; what stands beside it, such as its check code, stays."""

    def put(span: Column) -> Column:
        part = F.substring(value, span["begin"], span["end"] - span["begin"] + 1)
        before = F.substring(value, F.lit(1), span["begin"] - 1)
        return _let(part, lambda own: F.concat(before, _whole_card(own, key), F.substring(value, span["end"] + 1, F.length(value))))

    return _let(_card_within(value), lambda span: F.when(span.isNotNull(), put(span)))


def _whole_card(value: Column, key: str) -> Column:
    """All digits but the first and the check digit are permuted."""
    letters, digits = _letters(value), _digits(value)
    last = F.length(value) - 1
    body = _permuted_text(letters, _only(letters, DIGITS, first=1, last=last), key, "card")
    valid = F.length(digits).between(13, 19) & (_luhn(digits, 1) % 10 == 0)

    def checked(without: Column) -> Column:
        return F.concat(without, F.pmod(10 - _luhn(_digits(without), 0) % 10, F.lit(10)).cast("string"))

    return F.when(valid, _let(F.substring(body, F.lit(1), last), checked))


def _valid_iban(value: Column) -> Column:
    return _mod_97(F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))) == 1


def _iban(value: Column, key: str) -> Column:
    country, account = F.substring(value, 1, 2), F.substring(value, F.lit(5), F.length(value))
    letters = _letters(account)
    alphabets = F.transform(letters, lambda letter: F.when(letter.between("0", "9"), DIGITS).otherwise(UPPER))
    valid = _valid_iban(value)

    def checked(new: Column) -> Column:
        check = F.lpad((98 - _mod_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, new)

    return F.when(valid, _let(_permuted_text(letters, alphabets, key, "iban"), checked))


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda part: part.cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, part: total * 256 + part)
    new = _permuted_number(number, 1 << 16, 1 << 16, key, "ip")
    return _let(
        new, lambda n: F.concat_ws(".", *[F.pmod(F.shiftright(n, shift), F.lit(256)).cast("string") for shift in (24, 16, 8, 0)])
    )


def _date(value: Column, key: str) -> Column:
    iso = value.rlike("^[0-9]{4}")
    mark = F.substring(value, 3, 1)
    year = F.when(iso, F.substring(value, 1, 4)).otherwise(F.substring(value, 7, 4))
    month = F.when(iso, F.substring(value, 6, 2)).otherwise(F.substring(value, 4, 2))
    day = F.when(iso, F.substring(value, 9, 2)).otherwise(F.substring(value, 1, 2))
    number = F.datediff(F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd")), F.lit(FIRST_DAY).cast("date"))
    low, high = DAYS

    def written(new: Column) -> Column:
        parts = [F.date_format(new, part) for part in ("dd", "MM", "yyyy")]
        return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.concat(parts[0], mark, parts[1], mark, parts[2]))

    def moved(day: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), _permuted_number(day, low, high, key, "date").cast("int"))
        return F.when((day >= 0) & (day < low * high), _let(new, written))

    return _let(number.cast("bigint"), moved)


def _phone(value: Column, key: str) -> Column:
    """National digits are permuted; the country code stays, and codes that begin with 2 to 9, or with 0 or 1, go on doing so."""
    letters = _letters(value)
    code = F.length(F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .\-(])", 0))
    american = value.rlike(r"(?:\([0-9]{3}\) ?[0-9]{3}|[2-9][0-9]{2}[ .\-][2-9][0-9]{2})[ .\-][0-9]{4}$")
    size = F.length(value)
    area = F.when(value.rlike(r"\) ?[0-9]{3}[ .\-][0-9]{4}$"), F.instr(value, "(")).otherwise(size - 12)

    def alphabet(letter: Column, at: Column) -> Column:
        leading = american & ((at == area) | (at == size - 8))
        first = F.when(letter >= "2", LEADING).otherwise(OTHER)
        return F.when((at < code) | ~letter.between("0", "9"), "").when(leading, first).otherwise(DIGITS)

    return _permuted_text(letters, F.transform(letters, alphabet), key, "phone")


def _ssn(value: Column, key: str) -> Column:
    """The group's first digit and the area stay, and with them its validity; five digits are permuted."""
    letters = _letters(value)
    group = F.substring(value, 5, 1) != "0"
    free = F.transform(
        letters, lambda letter, at: F.when(at.isin(8, 9) | (group & (at == 5)), DIGITS).when(at == 10, DIGITS[1:]).otherwise("")
    )
    return F.when(F.substring(value, -1, 1) != "0", _permuted_text(letters, free, key, "ssn")).otherwise(
        _permuted_text(letters, _only(letters, DIGITS[1:], first=7), key, "ssn0")
    )


def _email(value: Column, key: str) -> Column:
    letters = _letters(value)
    kept = F.length(value) - F.length(F.substring_index(value, ".", -1))
    alphabets = F.zip_with(
        _by_class(letters), F.sequence(F.lit(0), F.length(value) - 1), lambda alphabet, at: F.when(at < kept, alphabet).otherwise("")
    )
    return _permuted_text(letters, alphabets, key, "email")


def _key(value: Column, key: str) -> Column:
    letters = _letters(value)
    return _permuted_text(letters, _only(letters, UPPER + DIGITS, first=4), key, "key")


def _hex(value: Column, key: str) -> Column:
    """Digits of either case are one number; the new ones take the old ones' case, or that of all letters."""
    letters = _letters(F.lower(value))
    small, capitals = value == F.lower(value), value == F.upper(value)

    def cased(new: Column) -> Column:
        mixed = F.zip_with(_letters(new), _letters(value), lambda digit, old: F.when(old.between("A", "F"), F.upper(digit)).otherwise(digit))
        return F.when(small, new).when(capitals, F.upper(new)).otherwise(F.array_join(mixed, ""))

    return _let(_permuted_text(letters, _only(letters, HEX), key, "hex"), cased)


KINDS = {
    "email": _email,
    "key": _key,
    "hex": _hex,
    "iban": _iban,
    "date": _date,
    "ip": _ip,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def _kind(value: Column) -> Column:
    """The first pattern that the value fits as a whole; marks around it are not part of it."""
    chosen = F.when(F.instr(value, "@") > 0, "email")
    for kind, pattern in PATTERNS.items():
        if kind not in ("email", "hex"):
            fits = value.rlike(f"^(?:{pattern})$")
            # hexadecimal digits may look like an account
            chosen = chosen.when(fits & (~value.rlike("^[0-9A-F]+$") | _valid_iban(value)) if kind == "iban" else fits, kind)
    return chosen.otherwise("hex")


def _new(find: Column, key: str) -> Column:
    """The pseudonym, or null where the validation fails."""
    new = F.lit(None).cast("string")
    for name, permuted in KINDS.items():
        new = F.when(find["kind"] == name, permuted(find["value"], key)).otherwise(new)
    return new


FINDS = "array<struct<kind:string,value:string,new:string>>"


def pseudonyms(docs: DataFrame, *, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` as a struct ``doc``, with its new text and its finds (kind, value, new) in reading order."""
    whole = F.col("text")
    own = {f"__own_{place}": name for place, name in enumerate(docs.columns)}  # no name can clash with a working column
    rows = docs.select(*[F.col(f"`{name}`").alias(mark) for mark, name in own.items()], F.col(f"`{text}`").cast("string").alias("text"))
    values = F.when(whole.rlike(MAYBE), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    typed = F.transform("values", lambda value: F.struct(_kind(value).alias("kind"), value.alias("value")))
    finds = F.transform(
        "typed",
        lambda find: F.struct(find["kind"].alias("kind"), find["value"].alias("value"), _new(find, key).alias("new")),
    )
    found = F.size("values") > 0
    rows = _once(rows, "values", values)
    rows = _once(rows, "typed", F.when(found, typed))
    rows = _once(rows, "finds", F.when(found, finds))
    joined = F.array_join(
        F.zip_with(
            F.split("text", ANY, -1),
            F.col("finds"),
            lambda piece, find: F.concat(piece, F.coalesce(find["new"], find["value"], F.lit(""))),
        ),
        "",
    )
    valid = F.filter("finds", lambda find: find["new"].isNotNull())
    doc = F.struct(*[F.col(mark).alias(name) for mark, name in own.items()]).alias("doc")
    return rows.select(doc, F.when(found, joined).otherwise(whole).alias("text"), F.coalesce(valid, F.array().cast(FINDS)).alias("finds"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return masked.select(
        "doc.doc_id",
        "text",
        F.size("finds").cast("bigint").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("finds", lambda find: find["kind"]))), ",").alias("kinds"),
    )


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms in their texts."""
    masked = pseudonyms(docs).withColumnRenamed("text", "__text")
    names = docs.columns
    return masked.select(*[F.col("__text").alias(name) if name == "text" else F.col(f"doc.`{name}`") for name in names])
