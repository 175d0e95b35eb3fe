"""Format-preserving pseudonyms for personal data, by a keyed Feistel network."""

import hashlib
import hmac
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

_DIGIT = "0123456789"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Characters of an account number after country and check digits, by country.
ACCOUNT_CHARS = {
    11: "NO", 12: "BE BI", 14: "DK FI FO GL NL FK SD", 15: "MK SI", 16: "AT BA EE KZ LT LU XK MN",
    17: "CH CR HR LI LV", 18: "BG BH DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM TL SO",
    20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "PT ST LY", 22: "IS TR", 23: "DJ FR GR IT MC MR SM",
    24: "AL AZ BY CY DO GT HU LB NI PL SV", 25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC", 28: "LC",
    29: "RU",
}


def _accounts() -> str:
    """Each country's numbers in groups of four, so that no word or number behind them is taken in; of
    other countries any length."""
    known = [
        rf"(?:{codes.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{size // 4}}}" + (rf" ?[A-Z0-9]{{{size % 4}}}" if size % 4 else "")
        for size, codes in ACCOUNT_CHARS.items()]
    others = rf"(?!{'|'.join(ACCOUNT_CHARS.values()).replace(' ', '|')})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join([*known, others])})(?![A-Za-z0-9])"


#: What is looked for, in this order where two begin at the same place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=\b(?:password|passwd|secret|token|api_key)=)[^\s,;\"'<>]++",
    "iban": _accounts(),
    "iso_date": r"(?<![\d-])(?:19|20)\d{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])",
    "day_date": r"(?<![\d/.])(?:0[1-9]|[12]\d|3[01])(?:/(?:0[1-9]|[12]\d|3[01])/|\.(?:0[1-9]|1[0-2])\.)(?:19|20)\d{2}(?!\d|[/.]\d)",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[ .-]\d{4}(?!\d)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
}
# A run of 13 digits or more, in groups of any length, up to where something else begins.
_OTHERS = "|".join(PATTERNS[k] for k in ("iso_date", "day_date", "ip", "ssn", "phone"))
PATTERNS["card"] = rf"(?<![\d.-])\d(?:(?:[ -](?!{_OTHERS}))?\d){{12,}}+"
# Within a word only a digit can begin a match, so most places are passed by one look.
PATTERN = r"(?:(?<![A-Za-z])|(?=\d))(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"

#: First digits and lengths of the numbers of the large card networks: looked for inside longer numbers, too.
NETWORKS = [
    ("4", 16), ("5[1-5]", 16), ("222[1-9]", 16), ("22[3-9]", 16), ("2[3-6]", 16), ("27[01]", 16), ("2720", 16),
    ("6011", 16), ("64[4-9]", 16), ("65", 16), ("62", 16), ("35", 16), ("3[47]", 15), ("30[0-5]", 14), ("3[68]", 14),
]

#: First day and number of days of the dates that are permuted: 1900-01-01 to 2099-12-31.
FIRST_DAY = "1900-01-01"
_DAY_PARTS = (17, 4297)


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where a lambda refers to it."""
    return F.transform(F.array(value), body)[0]


def _long(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("bigint")


def _quotient(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def derived(key: str, use: str) -> str:
    """A key for one use alone, made on the driver by a keyed one-way hash. Only derived keys are part of
    a plan, so `explain` and event logs never hold `key` itself; who reads them can undo the
    pseudonyms of that use, so plans of this operator are to be kept like its input."""
    return hmac.new(key.encode(), use.encode(), hashlib.sha256).hexdigest()


def feistel(value: Column, left: Column, right: Column, key: str, tweak: str, back: bool = False) -> Column:
    """Keyed permutation of the numbers 0 … left · right - 1; `back` undoes it."""
    halves = _mixed_halves(_quotient(value, right), value % right, left, right, key, tweak, back)
    return let(halves, lambda s: s["l"] * right + s["r"])


def _mixed_halves(
    l: Column, r: Column, left: Column, right: Column, key: str, tweak: str, back: bool = False
) -> Column:
    """The halves, numbers below `left` and `right`, are added to each other's keyed hash in turn, so
    every round, and with it the whole, is one-to-one on exactly these ranges."""
    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))

    keys = F.array(*[F.lit(derived(key, f"{tweak}:{n}")) for n in range(1, ROUNDS + 1)])

    def mark(n: Column, half: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.element_at(keys, n), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 14), 16, 10).cast("bigint")

    def turn(state: Column, n: Column) -> Column:
        def moved(half: Column, other: Column, size: Column) -> Column:
            by = mark(n, other) % size
            return F.pmod(half - by, size) if back else (half + by) % size

        odd = n % 2 == 1
        return F.struct(
            F.when(odd, moved(state["l"], state["r"], left)).otherwise(state["l"]).alias("l"),
            F.when(odd, state["r"]).otherwise(moved(state["r"], state["l"], right)).alias("r"))

    return F.aggregate(rounds, F.struct(l.alias("l"), r.alias("r")), turn)


def _digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def permuted_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """Another text of as many digits, up to 30."""
    def power(n: Column) -> Column:
        return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")

    def number(part: Column) -> Column:
        return F.concat(F.lit("0"), part).cast("bigint")

    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    halves = _mixed_halves(
        number(F.substr(digits, F.lit(1), half)), number(F.substr(digits, half + 1)),
        power(half), power(size - half), key, tweak, back)
    return let(halves, lambda s: F.concat(
        F.lpad(s["l"].cast("string"), half, "0"), F.lpad(s["r"].cast("string"), size - half, "0")))


def permuted_letters(letters: Column, key: str, tweak: str) -> Column:
    """Another text of as many capital letters; those after the 24th are permuted apart."""
    def each(part: Column) -> Column:
        return F.filter(F.split(part, ""), lambda c: c != "")

    def number(part: Column) -> Column:
        return F.aggregate(each(part), _long(0), lambda n, c: n * 26 + F.ascii(c) - 65)

    def power(part: Column) -> Column:
        return F.aggregate(each(part), _long(1), lambda n, _: n * 26)

    def text(value: Column, part: Column) -> Column:
        return F.aggregate(
            each(part), F.struct(value.alias("n"), F.lit("").alias("out")),
            lambda s, _: F.struct(
                _quotient(s["n"], _long(26)).alias("n"),
                F.concat(F.char(s["n"] % 26 + 65), s["out"]).alias("out")),
            lambda s: s["out"])

    def permuted(part: Column, of: str) -> Column:
        half = F.floor(F.length(part) / 2).cast("int")
        x, y = F.substr(part, F.lit(1), half), F.substr(part, half + 1)
        halves = _mixed_halves(number(x), number(y), power(x), power(y), key, of)
        return let(halves, lambda s: F.concat(text(s["l"], x), text(s["r"], y)))

    return F.concat(permuted(F.substring(letters, 1, 24), tweak),
                    permuted(F.substr(letters, F.lit(25)), f"{tweak}-rest"))


def _filled(shape: Column, values: Column, first: str = "0", last: str = "9") -> Column:
    """`shape` with its characters from `first` to `last` replaced by `values`, in order."""
    return F.aggregate(
        F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda s, c: F.when(
            (c >= first) & (c <= last),
            F.struct(F.concat(s["out"], F.substr(values, s["n"] + 1, F.lit(1))).alias("out"), (s["n"] + 1).alias("n")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n"))),
        lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled; a valid number's ends in 0."""
    def part(c: Column, n: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(n % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    each = F.transform(F.split(F.reverse(digits), ""), part)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def mod97(text: Column) -> Column:
    """An account number's letters and digits, first four last, as a number modulo 97."""
    moved = F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4))
    return F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda s, c: F.when(c <= "9", (s * 10 + F.when(c <= "9", c).otherwise("0").cast("int")) % 97)
        .otherwise((s * 100 + F.ascii(c) - 55) % 97))


def _numbers_in(run: Column) -> Column:
    """The valid card numbers in a run of digit groups, each as it is written there: first those of the
    networks that begin and end with a group, then others of 13 to 19 digits that do, both in groups
    of four digits or more but for the last, then those of the networks inside one longer group."""
    def found(pattern: str) -> Column:
        # Looking ahead finds the numbers of every place, overlapping ones, too.
        return F.regexp_extract_all(run, F.lit(pattern), F.lit(1))

    def networks(separator: str) -> str:
        sizes = [(first, size - len(re.sub(r"\[[^]]*\]", "x", first))) for first, size in NETWORKS]
        return "|".join(rf"{first}(?:{separator}\d){{{rest}}}" for first, rest in sizes)

    grouped = F.concat(
        found(rf"(?<!\d)(?=({networks('[ -]?')})(?!\d))"),
        *[found(rf"(?<!\d)(?=([1-9](?:[ -]?\d){{{size - 1}}})(?!\d))") for size in range(19, 12, -1)])
    grouped = F.filter(grouped, lambda x: x.rlike(r"^\d{4,}(?:[ -]\d{4,})*(?:[ -]\d+)?$"))
    every = F.array_distinct(F.concat(grouped, found(f"(?=({networks('')}))")))
    return F.filter(every, lambda x: luhn_sum(_digits_of(x)) % 10 == 0)


def _card(match: Column, key: str) -> Column:
    """The run with every valid card number in it replaced; other digits, such as an expiry date, a year
    or a code beside it, stay. Of numbers that overlap the first of `_numbers_in` counts."""
    def made(digits: Column) -> Column:
        middle = permuted_digits(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card")
        body = F.concat(F.substring(digits, 1, 1), middle)
        return F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))

    # Numbers are first taken out by their place in the list, so that no pseudonym is replaced again.
    def taken(run: Column, n: Column, x: Column) -> Column:
        return F.replace(run, x, F.concat(F.lit("<"), n.cast("string"), F.lit(">")))

    def replaced(numbers: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(numbers))
        gaps = F.aggregate(places, match, lambda run, n: taken(run, n, F.element_at(numbers, n)))
        return F.aggregate(places, gaps, lambda run, n: F.replace(
            run, F.concat(F.lit("<"), n.cast("string"), F.lit(">")),
            let(F.element_at(numbers, n), lambda x: _filled(x, made(_digits_of(x))))))

    return let(_numbers_in(match), lambda numbers: F.when(
        F.size(numbers) > 0, replaced(numbers)).otherwise(match))


def _iban(match: Column, key: str) -> Column:
    """All digits and all letters of the account part are permuted, each at their places."""
    def valid(text: Column) -> Column:
        account = F.substr(text, F.lit(5))
        digits = permuted_digits(_digits_of(account), key, "iban")
        letters = permuted_letters(F.regexp_replace(account, "[^A-Z]", ""), key, "iban-letters")
        body = F.concat(F.substring(text, 1, 2), F.lit("00"), _filled(_filled(account, digits), letters, "A", "Z"))
        check = F.lpad((98 - mod97(body)).cast("string"), 2, "0")
        whole = _filled(_filled(match, F.concat(check, digits)), F.concat(F.substring(text, 1, 2), letters), "A", "Z")
        return F.when(mod97(text) == 1, whole).otherwise(match)

    return let(F.regexp_replace(match, " ", ""), valid)


def _date(match: Column, form: str, key: str) -> Column:
    def permuted(day: Column) -> Column:
        left, right = map(_long, _DAY_PARTS)
        number = feistel(_long(F.datediff(day, F.lit(FIRST_DAY).cast("date"))), left, right, key, "date")
        return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), number.cast("int")), form)

    return let(F.try_to_date(match, form), lambda day: F.when(day.isNotNull(), permuted(day)))


def _ip(match: Column, key: str) -> Column:
    number = F.aggregate(F.split(match, r"\."), _long(0), lambda s, c: s * 256 + c.cast("bigint"))

    def dotted(n: Column) -> Column:
        return F.concat_ws(".", *[(F.shiftright(n, by) % 256).cast("string") for by in (24, 16, 8, 0)])

    return let(feistel(number, _long(65536), _long(65536), key, "ip"), dotted)


def _phone(match: Column, key: str) -> Column:
    """The last ten digits if they are a valid number of that plan, else all but the first three."""
    def permuted(digits: Column) -> Column:
        last = F.right(digits, F.lit(10))
        area = F.substring(last, 1, 3).cast("bigint") - 200
        local = F.substring(last, 4, 7).cast("bigint") - 2_000_000
        number = feistel(area * 8_000_000 + local, _long(800), _long(8_000_000), key, "phone")
        ten = let(number, lambda n: F.concat(
            (_quotient(n, _long(8_000_000)) + 200).cast("string"), (n % 8_000_000 + 2_000_000).cast("string")))
        size = F.length(digits)
        rest = permuted_digits(F.substr(digits, F.lit(4)), key, "abroad")
        planned = (size >= 10) & (area >= 0) & (local >= 0) & ~match.rlike(r"^\+(?!1\D)")
        return _filled(match, F.when(planned, F.concat(F.substr(digits, F.lit(1), size - 10), ten))
                       .otherwise(F.concat(F.substring(digits, 1, 3), rest)))

    return let(_digits_of(match), permuted)


def _ssn(match: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99 and numbers 0001-9999 stay within themselves."""
    area = F.substring(match, 1, 3).cast("bigint")
    place = area - F.when(area > 666, 2).otherwise(1)
    number = (place * 99 + F.substring(match, 5, 2).cast("bigint") - 1) * 9999 + F.substring(match, 8, 4).cast("bigint") - 1

    def text(n: Column) -> Column:
        left = _quotient(n, _long(9999 * 99))
        return F.concat_ws(
            "-", F.lpad((left + F.when(left >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((_quotient(n, _long(9999)) % 99 + 1).cast("string"), 2, "0"),
            F.lpad((n % 9999 + 1).cast("string"), 4, "0"))

    return let(feistel(number, _long(898 * 99), _long(9999), key, "ssn"), text)


def _keyed_text(value: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(derived(key, kind)), value), 256)


def _secret(match: Column, key: str) -> Column:
    """As many hexadecimal digits as the secret has characters."""
    size = F.length(match)
    return let(_keyed_text(match, key, "secret"), lambda first: F.substr(F.concat(first, F.when(
        size > 64, F.array_join(F.transform(
            F.sequence(F.lit(1), _quotient(size - 1, _long(64)).cast("int")),
            lambda n: _keyed_text(F.concat_ws(":", first, n.cast("string")), key, "secret-rest")), "")
    ).otherwise("")), F.lit(1), size))


def kind_of(match: Column) -> Column:
    """Name of the first pattern that the whole match has."""
    found = F.lit("secret")  # known by what stands before it
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        found = F.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(found)
    return found


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """The value that stands for `match`, of the same form; what is not valid stays as it is."""
    local = F.concat(F.lit("user"), F.substring(_keyed_text(match, key, "email"), 1, 20))
    slashed = F.coalesce(_date(match, "dd/MM/yyyy", key), _date(match, "MM/dd/yyyy", key))
    return F.coalesce(
        F.when(kind == "email", F.concat(local, F.lit("@"), F.substring_index(match, "@", -1)))
        .when(kind == "key", F.concat(F.lit("AKIA"), F.upper(F.substring(_keyed_text(match, key, "key"), 1, 16))))
        .when(kind == "secret", _secret(match, key))
        .when(kind == "iban", _iban(match, key))
        .when(kind == "iso_date", _date(match, "yyyy-MM-dd", key))
        .when((kind == "day_date") & F.contains(match, F.lit("/")), slashed)
        .when(kind == "day_date", _date(match, "dd.MM.yyyy", key))
        .when(kind == "ip", _ip(match, key))
        .when(kind == "ssn", _ssn(match, key))
        .when(kind == "phone", _phone(match, key))
        .when(kind == "card", _card(match, key)),
        match)


def pseudonymise(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `text` with pseudonyms, `n_found` and the `kinds` found, in order, of every row.

    Card numbers (Luhn), account numbers (mod 97), addresses, phone and social security numbers and
    calendar dates of 1900 to 2099 are permuted within their form by a keyed Feistel network, with
    check digits made anew, so equal values have equal pseudonyms in all documents and different
    ones stay different. E-mail names (80 bits), access keys and passwords (of any length) get keyed
    hashes of their form, so equality is kept and a collision is not to be expected.
    All digits and letters of an account number after its check digits change; digits beside a
    card number stay, in runs of any length. What looks like a number or date and is not valid stays. Texts without a match are untouched;
    null stays null, an empty text empty, long texts are read whole; rows, repeated ones too, are
    independent, without shuffle or Python; an empty table gives no rows. Plans hold derived keys, not
    `key`: see `derived`.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"),
        F.when(text.rlike(PATTERN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("_found"))
    rows = rows.withColumn("kinds", F.transform("_found", kind_of)).withColumn(
        "_new", F.zip_with("_found", "kinds", lambda m, k: pseudonym(m, k, key)))
    parts = F.split("text", PATTERN, -1)
    return rows.select(
        "doc_id",
        F.when(F.col("_found").isNull(), F.col("text")).otherwise(F.array_join(F.zip_with(
            parts, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).alias("text"),
        F.coalesce(F.size("_found"), F.lit(0)).alias("n_found"),
        F.coalesce(F.col("kinds"), F.array().cast("array<string>")).alias("kinds"),
    )
