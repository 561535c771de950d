"""Format-preserving Feistel pseudonyms for personal data, in SQL functions.

Found values are validated, split into elements of a mixed radix (digits,
letters, octets, parts of a day number), permuted by a keyed unbalanced Feistel
network on the two halves of the elements, and written back in their own
format; check digits are computed anew.  The permutation depends on the key,
the kind and the value alone, so equal values get equal pseudonyms in every
document, different values different ones, and the key holder can invert them.

Kinds: e-mail addresses (letters and digits of the local part and the domain
but its last label), IPv4 addresses, payment cards (Luhn; 13 to
19 digits, alone in any grouping, beside other numbers in the usual layouts, the
longest valid one first), IBANs (mod 97, of their country's length;
of a country not in the table only if no capitals or digits follow), US
social security numbers, phone numbers (below), dates (yyyy-mm-dd, dd/mm/yyyy,
dd.mm.yyyy; within blocks of 3,600 days, so a date keeps its decade), and
credentials (access key ids, tokens known by their prefix such as ghp_ and sk-,
what follows Bearer, values after password, passphrase, token and the like: from
6 characters to the closing quote, or without quotes to the next white space or
quote, however long; their ASCII letters and digits change, other characters
stay).

Formats say what a value is, with one rule of context: four numbers after
"version", "release" or a v are a version, no address.  Dates need no context, so
any date changes.

Phone numbers: + and 7 to 15 digits in groups of any size (a (0) after the
country code included); (ddd) ddd-dddd and ddd ddd dddd, each also after a 1;
national forms with a leading 0 in pairs (06 12 34 56 78), as area and two groups
((020) 7946 0958, 0161 496 0000) or as area and one group (07700 900123).  Left
out: numbers of bare digits without + (0612345678, 5551234567), the prefix 00,
other national groupings without a leading 0, and extensions.

Defined cases: null stays null, empty stays empty; a candidate that fails its
validation (wrong check digit, day 31/02) is left; equal rows get equal
results; every other column is returned untouched, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8


class Inverse(str):
    """A key whose pseudonyms are turned back."""

# --- fixed values: the formats looked for (no unbounded repeated group, so the
# matcher's depth is bounded on any text) -------------------------------------
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])"
#: Identifiers that begin with their kind; that prefix stays.
KEY_PREFIX = r"(?:AKIA|ASIA|gh[pousr]_|github_pat_|sk-(?:proj-)?|xox[abprs]-|glpat-|Bearer )"
KEY_ID = (r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}+|github_pat_[0-9A-Za-z_]{20,}+|sk-(?:proj-)?[0-9A-Za-z]{20,}+"
          r"|xox[abprs]-[0-9A-Za-z-]{10,}+|glpat-[0-9A-Za-z_-]{20,}+|Bearer [0-9A-Za-z._~+/=-]{16,}+)(?![A-Za-z0-9])")
SECRET = (r"(?i:password|passwd|passphrase|pwd|token|secret|api[_-]?key)[ ]{0,3}[=:][ ]{0,3}"
          r"(?:\"[^\"\r\n]{6,}+\"|'[^'\r\n]{6,}+'|[\"']?[^\s\"']{6,}+)")
#: Length of an IBAN by country (the registry's and other published ones).
IBAN_LENGTH = {
    15: "NO",
    16: "BE",
    18: "DK|FI|FK|FO|GL|NL|SD",
    19: "MK|SI",
    20: "AT|BA|EE|KZ|LT|LU|MN|XK",
    21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|IQ|OM|SO|TL",
    24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|CV|GW|LY|MZ|PT|ST",
    26: "DZ|IR|IS|TR",
    27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG",
    29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE",
    31: "MT|SC",
    32: "LC",
    33: "RU",
}
#: A listed country's ends at its own length, any other's before a group that begins an IBAN.
IBAN = (r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTH.items())
        + f"|(?!{'|'.join(IBAN_LENGTH.values())})"
        + r"[A-Z]{2}[0-9]{2}(?: ?(?![A-Z]{2}[0-9]{2} )[A-Z0-9]{4}){2,7}(?: ?(?![A-Z]{2}[0-9]{2})[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
IPV4 = r"(?<![0-9])(?<![0-9]\.)(?<!(?i:version|release)[ :=]{1,2})(?<![vV])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
#: A run of digits in groups that starts with 13 digits and may hold several cards and
#: other numbers (_card_run); it stops before a group that begins an address or date.
_RUN = r"[0-9][0-9 -]{11,}(?<=[0-9])(?![0-9])"
CARD = (r"(?<![0-9])(?=[0-9](?:[ -]?[0-9]){12})(?:" + _RUN
        + r"(?!\.[0-9]{1,3}\.[0-9]|/[0-9]{2}/[0-9]|[A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9])|" + _RUN + ")")
#: Layouts of a card that has other numbers beside it, and any grouping of one alone.
CARD_GROUPS, LAYOUT = 5, (r"^(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,3}"
                          r"|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
                          r"|[0-9]{4}[ -][0-9]{8}[ -][0-9]{1,7})$")
CARD_ALONE = r"^[0-9](?:[ -]?[0-9]){12,18}$"
#: After +: countries whose numbers have a fixed length, then any other.
PHONE = (r"(?<![0-9A-Za-z])\+(?:(?:1|7|30|44|52|90|91)(?:SEP?\(0\))?(?:SEP{0,2}[0-9]){10}"
         r"|(?:27|31|33|34|41|48|61|212|351)(?:SEP?\(0\))?(?:SEP{0,2}[0-9]){9}|(?:45|47|65|216|852)(?:SEP{0,2}[0-9]){8}"
         r"|[0-9]{1,3}(?:SEP{0,2}[0-9]){6,12})(?![0-9])"
         r"|(?<![0-9A-Za-z.-])(?:1[ .-])?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9A-Za-z])\(0[0-9]{1,4}\)[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])"
         r"|(?<![0-9A-Za-z.-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
         r"|(?<![0-9A-Za-z.-])0[1-9](?:GAP[0-9]{2}){4}(?![0-9]|[.-][0-9])"
         r"|(?<![0-9A-Za-z.-])(?:0[1-9][0-9]{0,3}GAP[0-9]{3,4}GAP[0-9]{3,4}|0[1-9][0-9]{2,4}[ /-][0-9]{6,8})(?![0-9]|[.-][0-9])"
         ).replace("SEP", "[ \u00a0\u202f./()-]").replace("GAP", "[ \u00a0\u202f.-]")
#: Country codes by their first digits; then (0) or a trunk 0 or 1 of national numbers.
_PREFIX = (r"^(?:\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})(?:[ \u00a0\u202f./()-]?\(0\))?"
           r"|\(?0|1(?=[ .(-])|)")
# ------------------------------------------------------------------------------
_ANY = "|".join((EMAIL, KEY_ID, SECRET, IBAN, DATE, SSN, IPV4, CARD, PHONE))
#: Characters or words without which nothing above can match.
_HINT = r"[0-9@=:_]|sk-|xox|glpat-|Bearer "


def _whole(kind: str) -> str:
    return f"^(?:{kind})$"


# ------------------------------------------------------------ Feistel core
def _element(value: Column, radix: Column, base: Column, char: Column, place: Column | None = None) -> Column:
    place = F.lit(0) if place is None else place
    return F.struct(value.cast("int").alias("v"), radix.cast("int").alias("r"), base.cast("int").alias("b"), char.alias("c"),
                    place.cast("int").alias("p"))


def _permuted(elements: Column, kind: str, key: str) -> Column:
    """The elements after a keyed Feistel network over their halves: in each
    round the values of one half are shifted by hashes of the other.  An
    :class:`Inverse` key takes the rounds back, last first."""
    sign, rounds = (-1, range(ROUNDS - 1, -1, -1)) if isinstance(key, Inverse) else (1, range(ROUNDS))
    half = F.floor(F.size(elements) / 2).cast("int")

    def state(left: Column, right: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"))

    def shifted(part: Column, other: Column, i: Column) -> Column:
        seed = F.concat(F.lit(f"{key}|{kind}|"), i.cast("string"), F.lit("|"),
                        F.array_join(F.transform(other, lambda x: x.v.cast("string")), ","), F.lit("|"))
        digest = F.sha2(seed, 256)
        # The hash of the other half is made once and bound as a one-element array.
        return F.flatten(F.transform(F.array(digest), lambda d: F.transform(part, lambda x, j: _moved(x, j, d))))

    def _moved(x: Column, j: Column, d: Column) -> Column:
        draw = F.conv(F.substring(F.sha2(F.concat(d, j.cast("string")), 256), 1, 12), 16, 10).cast("long")
        return F.when(x.r > 1, _element(F.pmod(x.v + draw * sign, x.r), x.r, x.b, x.c, x.p)).otherwise(x)

    def turn(acc: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, state(shifted(acc.left, acc.right, i), acc.right)).otherwise(
            state(acc.left, shifted(acc.right, acc.left, i)))

    start = state(F.slice(elements, F.lit(1), half), F.slice(elements, half + 1, F.size(elements) - half))
    return F.aggregate(F.array(*map(F.lit, rounds)), start, turn, lambda acc: F.concat(acc.left, acc.right))


def _chars(text: Column, first: Column, last: Column, hex_only: Column | None = None) -> Column:
    """An element per character; letters and digits at places first..last
    (from 0) may change within their class, all others stay."""
    letters = F.lit(26) if hex_only is None else F.when(hex_only, F.lit(6)).otherwise(F.lit(26))

    def all_of(of: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            code = F.ascii(c)
            base = (F.when(code.between(48, 57), 48).when(code.between(97, 122), 97).when(code.between(65, 90), 65).otherwise(0))
            radix = (F.when((j < of.first) | (j > of.last) | (base == 0), 1).when(base == 48, 10)
                     .when(base == 97, of.letters).otherwise(26))
            return _element(F.when(radix > 1, code - base).otherwise(0), radix, base, c, j)
        return F.transform(F.split(text, ""), one)
    # Bound, or a long value would be measured again for each of its characters.
    return _bound(F.struct(first.alias("first"), last.alias("last"), letters.alias("letters")), all_of)


def _rewritten(elements: Column, kind: str, key: str) -> Column:
    """The text after permuting the elements that may change; separators take
    no part, so a number is linked however it is grouped."""
    def write(e: Column) -> Column:
        def at(x: Column, char: Column) -> Column:
            return F.struct(x.p.alias("p"), char.alias("c"))
        new = F.transform(_permuted(F.filter(e, lambda x: x.r > 1), kind, key), lambda x: at(x, F.char(x.b + x.v)))
        kept = F.transform(F.filter(e, lambda x: x.r == 1), lambda x: at(x, x.c))
        return F.array_join(F.transform(F.sort_array(F.concat(new, kept)), lambda x: x.c), "")
    return _bound(elements, write)


def _numbers(pairs: list[tuple[Column, int]]) -> Column:
    return F.array(*(_element(v, F.lit(r), F.lit(0), F.lit("")) for v, r in pairs))


def _bound(value: Column, use) -> Column:
    """use(value) with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ------------------------------------------------------------ check digits
def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string; the last digit counts plainly."""
    n = F.length(digits)

    def add(acc: Column, d: Column) -> Column:
        v = d.cast("int")
        twice = F.when(v > 4, v * 2 - 9).otherwise(v * 2)
        return F.struct((acc.s + F.when(acc.i % 2 == 0, v).otherwise(twice)).alias("s"), (acc.i + 1).alias("i"))
    # The place counts from the right: start at the parity of the first digit.
    start = F.struct(F.lit(0).alias("s"), F.pmod(n - 1, F.lit(2)).cast("int").alias("i"))
    return F.aggregate(F.split(digits, ""), start, add, lambda acc: acc.s)


def _mod97(text: Column) -> Column:
    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97
    return F.aggregate(F.split(text, ""), F.lit(0), add)


# ------------------------------------------------------------ kinds
def _email(m: Column, key: str) -> Column:
    tld = F.length(F.substring_index(m, ".", -1))
    return _rewritten(_chars(m, F.lit(0), F.length(m) - tld - 1), "email", key)


def _key_id(m: Column, key: str) -> Column:
    kept = F.length(F.regexp_extract(m, "^" + KEY_PREFIX, 0))
    return _rewritten(_chars(m, kept, F.length(m)), "credential", key)


def _secret(m: Column, key: str) -> Column:
    def changed(value: Column) -> Column:
        chars = _chars(value, F.lit(0), F.length(value), value.rlike("^[0-9a-f]{16,}+[^0-9A-Za-z]*$"))
        return F.concat(m.substr(F.lit(1), F.length(m) - F.length(value)), _rewritten(chars, "credential", key))
    return _bound(F.regexp_extract(m, r"(?s)[=:][ ]{0,3}[\"']?(.*)$", 1), changed)


def _iban(m: Column, key: str) -> Column:
    plain = F.regexp_replace(m, " ", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(F.lit(1), F.lit(4)))
    new = _rewritten(_chars(m, F.lit(4), F.length(m)), "iban", key)

    def checked(s: Column) -> Column:
        bare = F.regexp_replace(s, " ", "")
        rest = F.concat(bare.substr(F.lit(5), F.length(bare)), bare.substr(F.lit(1), F.lit(2)), F.lit("00"))
        check = F.lpad((98 - _mod97(rest)).cast("string"), 2, "0")
        return F.concat(s.substr(F.lit(1), F.lit(2)), check, s.substr(F.lit(5), F.length(s)))
    return F.when(_mod97(turned) == 1, _bound(new, checked)).otherwise(m)


def _card(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    new = _rewritten(_chars(m, F.lit(1), F.length(m) - 2), "card", key)

    def checked(s: Column) -> Column:
        body = F.concat(F.regexp_replace(s.substr(F.lit(1), F.length(s) - 1), "[^0-9]", ""), F.lit("0"))
        return F.concat(s.substr(F.lit(1), F.length(s) - 1), F.pmod(10 - _luhn_sum(body) % 10, F.lit(10)).cast("string"))
    return F.when(_luhn_sum(digits) % 10 == 0, _bound(new, checked)).otherwise(m)


#: What is looked for in a run of digit groups after _marked_cards.
_IN_RUN = "|".join(("<[^>]*>", DATE, SSN, PHONE))


def _marked_cards(m: Column) -> Column:
    """A run of digit groups with every valid card in it, from left to right,
    between < and > (which are in no run)."""
    def marked(part: Column) -> Column:
        def card(text: Column, layout: str) -> Column:
            return text.rlike(layout) & (_luhn_sum(F.regexp_replace(text, "[^0-9]", "")) % 10 == 0)

        def of(groups: Column) -> Column:
            size = F.size(groups)

            def longest(i: Column) -> Column:
                tries = [F.when((i + n <= size) & _bound(F.concat(F.regexp_replace(F.get(groups, i), "^[ -]+", ""),
                                                                 *(F.get(groups, i + k) for k in range(1, n))),
                                                        lambda t: card(t, LAYOUT)), n) for n in range(CARD_GROUPS, 0, -1)]
                return F.struct(i.alias("i"), F.coalesce(*tries, F.lit(0)).alias("n"))

            def take(acc: Column, x: Column) -> Column:
                more = F.struct((x.i + x.n).alias("end"), F.concat(acc.cards, F.array(x)).alias("cards"))
                return F.when(x.i >= acc.end, more).otherwise(acc)
            starts = F.filter(F.transform(F.sequence(F.lit(0), size - 1), longest), lambda x: x.n > 0)
            none = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<i:int,n:int>>").alias("cards"))
            alone = F.regexp_replace(part, "^[ -]+", "")
            whole = F.array(F.struct(F.lit(0).alias("i"), size.alias("n")))

            def joined(first: Column, n: Column) -> Column:
                return F.array_join(F.slice(groups, first + 1, n), "")

            def written(cards: Column) -> Column:
                def one(x: Column, k: Column) -> Column:
                    end = F.when(k > 0, F.get(cards, k - 1).i + F.get(cards, k - 1).n).otherwise(0)
                    return F.concat(joined(end, x.i - end), F.regexp_replace(joined(x.i, x.n), "^([ -]*)(.*)$", "$1<$2>"))
                last = F.coalesce(F.element_at(cards, -1).i + F.element_at(cards, -1).n, F.lit(0))
                return F.when(F.size(cards) == 0, part).otherwise(
                    F.concat(F.array_join(F.transform(cards, one), ""), _bound(last, lambda e: joined(e, size - e))))
            found = _bound(F.aggregate(starts, none, take, lambda acc: acc.cards),
                           lambda c: F.when((F.size(c) == 0) & card(alone, CARD_ALONE), whole).otherwise(c))
            return _bound(found, written)
        return _bound(F.regexp_extract_all(part, F.lit("[ -]*[0-9]+"), F.lit(0)), of)

    # Double separators part the run.
    return F.array_join(F.transform(F.split(m, "(?<=[0-9])(?=[ -][ -])", -1), marked), "")


def _card_run(m: Column, key: str) -> Column:
    """A run with its cards rewritten and other kinds looked for in the rest."""
    def one(x: Column) -> Column:
        inner = x.substr(F.lit(2), F.length(x) - 2)
        return F.when(x.startswith("<"), _bound(inner, lambda c: _card(c, key))).otherwise(
            _by_kind(x, key, ((DATE, _date), (SSN, _ssn), (PHONE, _phone))))
    return _bound(_marked_cards(m), lambda s: _replaced(s, _IN_RUN, one))


def _phone(m: Column, key: str) -> Column:
    """The country code, a trunk 0 or 1 and brackets before the number stay; a
    first digit of the number that is not 0 does not become 0."""
    code = F.length(F.regexp_extract(m, _PREFIX, 0))
    first = F.length(F.regexp_extract(m, _PREFIX + r"[^0-9]*", 0))

    def with_first(x: Column) -> Column:
        here = (x.p == first) & (x.b == 48) & (x.r == 10)
        return F.when(here & (x.v > 0), _element(x.v - 1, F.lit(9), F.lit(49), x.c, x.p)).when(
            here, _element(F.lit(0), F.lit(1), F.lit(0), x.c, x.p)).otherwise(x)
    return _rewritten(F.transform(_chars(m, code, F.length(m)), with_first), "phone", key)


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: _element(x.cast("int"), F.lit(256), F.lit(0), F.lit("")))
    return F.array_join(F.transform(_permuted(octets, "ipv4", key), lambda x: x.v.cast("string")), ".")


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (m.substr(F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 001-665, 667-899
    new = _permuted(_numbers([(place, 898), (group - 1, 99), (serial - 1, 9999)]), "ssn", key)

    def text(e: Column) -> Column:
        a, g, s = (F.get(e, F.lit(i)).v for i in range(3))
        return F.concat_ws("-", F.lpad(F.when(a < 665, a + 1).otherwise(a + 2).cast("string"), 3, "0"),
                           F.lpad((g + 1).cast("string"), 2, "0"), F.lpad((s + 1).cast("string"), 4, "0"))
    return F.when(valid, _bound(new, text)).otherwise(m)


#: Days from 1970-01-01 to 0001-01-01, where blocks begin, and to the last day
#: of the last whole block before the year 10000.
FIRST_DAY = -719162
LAST_DAY = FIRST_DAY + (2932896 - FIRST_DAY + 1) // 3600 * 3600 - 1


def _date(m: Column, key: str) -> Column:
    iso = (F.when(m.substr(F.lit(5), F.lit(1)) == "-", m)
           .otherwise(F.concat_ws("-", m.substr(F.lit(7), F.lit(4)), m.substr(F.lit(4), F.lit(2)), m.substr(F.lit(1), F.lit(2)))))
    day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.lit("1970-01-01").cast("date"))
    side = 60
    inside = F.pmod(day - FIRST_DAY, F.lit(side * side))
    new = _permuted(_numbers([(F.floor(inside / side), side), (inside % side, side)]), "date", key)

    def text(e: Column) -> Column:
        moved = F.date_add(F.lit("1970-01-01").cast("date"), (day - inside + F.get(e, F.lit(0)).v * side + F.get(e, F.lit(1)).v).cast("int"))
        sep = m.substr(F.lit(3), F.lit(1))
        y, mo, d = (F.date_format(moved, f) for f in ("yyyy", "MM", "dd"))
        return F.when(m.substr(F.lit(5), F.lit(1)) == "-", F.concat_ws("-", y, mo, d)).otherwise(F.concat(d, sep, mo, sep, y))
    return F.when(day <= LAST_DAY, _bound(new, text)).otherwise(m)


def _by_kind(m: Column, key: str, kinds: tuple) -> Column:
    out = None
    for kind, make in kinds:
        test = m.rlike(_whole(kind))
        out = F.when(test, make(m, key)) if out is None else out.when(test, make(m, key))
    return out.otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one found value (itself if it fails validation)."""
    return _by_kind(m, key, ((EMAIL, _email), (KEY_ID, _key_id), (SECRET, _secret), (IBAN, _iban), (DATE, _date), (SSN, _ssn),
                             (IPV4, _ipv4), (CARD, _card_run), (PHONE, _phone)))


def _replaced(text: Column, pattern: str, use) -> Column:
    """The text with use(match) for every match of the pattern."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), use)
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    return F.array_join(pieces, "")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rewritten; all columns kept, in order."""
    if not key:
        raise ValueError("pseudonyms need a key")
    text = F.col(text_col)
    new = F.when(text.rlike(_HINT), _replaced(text, _ANY, lambda m: pseudonym(m, key))).otherwise(text)
    return docs.select(*(new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def restore(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` pseudonymised with ``key``, turned back."""
    return pseudonymise(docs, Inverse(key), text_col)


def count_found(text: Column) -> Column:
    """Values of the looked-for formats in a text (before validation; a run of
    digit groups counts the values found in it, at least 1)."""
    def count(m: Column) -> Column:
        inside = F.size(F.regexp_extract_all(_marked_cards(m), F.lit(_IN_RUN), F.lit(0)))
        return F.when(m.rlike(_whole(CARD)), F.greatest(inside, F.lit(1))).otherwise(1)
    found = F.aggregate(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), F.lit(0), lambda n, m: n + count(m))
    return F.when(text.rlike(_HINT), found).otherwise(F.lit(0)).cast("long")
