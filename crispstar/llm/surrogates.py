"""Personal data replaced by keyed surrogates of the same type and form."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crispstar.llm.common import in_arrow, raw, sliced, text_of
from crispstar.session import materialize

# Forms of address that tell a gender or none ("u"; one that ends in a full stop needs it), given names by
# script and gender, and syllables of family names.
ADDRESSES = {
    "m": [
        "Mr", "MR", "Mister", "Sir", "Lord", "Herr", "Herrn", "HERR", "Señor", "señor", "Sr", "Don", "don", "Monsieur", "monsieur", "M.", "Signor", "signor",
        "господин", "Господин", "господина", "господину", "г-н", "Г-н", "Κύριος", "κύριος", "κύριο",
    ],
    "f": [
        "Mrs", "MRS", "Ms", "MS", "Miss", "Madam", "Lady", "Dame", "Frau", "FRAU", "Fräulein", "Señora", "señora", "Sra", "Señorita", "señorita", "Srta", "Doña", "doña",
        "Madame", "madame", "Mme", "Mademoiselle", "mademoiselle", "Mlle", "Signora", "signora", "Dra", "Doctora", "doctora",
        "госпожа", "Госпожа", "госпожи", "госпоже", "г-жа", "Г-жа", "Κυρία", "κυρία",
    ],
    "u": [
        "Dr", "DR", "dr.", "Doctor", "Doktor", "doctor", "docteur", "Docteur", "Prof", "PROF", "prof.", "Professor", "professor", "Mx", "Rev", "Reverend", "Captain", "Capt",
        "доктор", "Доктор", "д-р", "Д-р", "профессор", "Профессор", "проф.", "κ.",
    ],
}
GIVEN = {
    ("latin", "m"): ["adam", "bruno", "carl", "david", "emil", "felix", "georg", "hugo", "ivan", "jonas", "karim", "leon", "marco", "noah", "oscar", "paul"],
    ("latin", "f"): ["anna", "berta", "clara", "diana", "elena", "flora", "greta", "hanna", "irene", "julia", "karla", "laura", "maria", "nora", "olga", "paula"],
    ("cyrillic", "m"): ["антон", "борис", "виктор", "глеб", "денис", "егор", "иван", "кирилл", "лев", "максим", "никита", "олег"],
    ("cyrillic", "f"): ["анна", "вера", "галина", "дарья", "елена", "жанна", "инна", "ксения", "лидия", "мария", "нина", "ольга"],
    ("greek", "m"): ["αντωνης", "γιωργος", "δημητρης", "ηλιας", "κωστας", "λευτερης", "νικος", "πετρος"],
    ("greek", "f"): ["αννα", "βασω", "γεωργια", "δαφνη", "ελενη", "ζωη", "κατερινα", "μαρια"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "han", "kel", "lam", "mir", "nor", "pas", "ran", "sten", "tol", "ver", "wil", "zan"],
    "cyrillic": ["ба", "вол", "гор", "дем", "кор", "лан", "мир", "нов", "пет", "род", "сав", "тих", "федь", "хар", "шум", "яр"],
    "greek": ["βα", "γαλ", "δημ", "θαν", "καρ", "λαμ", "μαρ", "νικ", "παπ", "ραλ", "σταθ", "τσακ"],
}
_GENDER = {a: g for g, names in ADDRESSES.items() for a in names}
TITLES = "|".join(sorted((re.escape(a) + r"\.?" * (a[-1] != ".") for a in _GENDER), key=len, reverse=True))
_CAPITAL = "[" + "".join(c for c in map(chr, range(128, 1 << 16)) if c.isupper() or c.istitle()) + "A-Z]"
_LETTER = r"[^\W\d_][̀-ͯ]*"
# A part between hyphens holds letters and apostrophes, but not the 's of a possessive.
_PART = rf"{_CAPITAL}[̀-ͯ]*(?:{_LETTER})*(?:(?!['’]s(?!\w))['’](?:{_LETTER})+)*"
_NAME = rf"(?:{_CAPITAL}\.(?:[-‐‑]{_CAPITAL}\.)*|{_PART}(?:[-‐‑](?:{_LETTER})+(?:(?!['’]s(?!\w))['’](?:{_LETTER})+)*)*)"
_BETWEEN = r"(?:(?:von|vom|van|der|den|de|la|las|los|del|della|di|da|dos|das|do|du|le|al|bin|ibn|zu|zum|zur|ter|ten|af|av|y)[\u00a0 ]+){0,3}"
_NAMED = rf"{_BETWEEN}(?:[dl]['’](?={_CAPITAL}))?{_NAME}"
_SEGMENT = re.compile(rf"[dl]['’](?={_CAPITAL})|(?P<segment>(?:{_LETTER})+(?:(?!['’]s(?!\w))['’](?:{_LETTER})+)*)")
_BARE = re.compile(rf"(?<!\w){_PART}(?!\w)")
_SUFFIXES = {"Jr", "Sr", "II", "III", "IV"}
_DATE = r"(?:\d{1,2}[./-]\d{1,2}[./-](?:\d{4}|\d{2})|\d{4}[./-]\d{2}[./-]\d{2})(?!\d)"
_GROUPS = r"\+?\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]?\d{2,4}"
# A phone does not run on into an address, a card or a social security number after a space.
_STOP = r"(?! \d{1,3}(?:\.\d{1,3}){3}(?!\d)| (?:\d{4}[ -]?){3}\d{4}| \d{3}-\d{2}-\d{4})"
PATTERNS = {
    "email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?<!\w)[0-9a-fA-F]{32,128}(?!\w)",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ipv6": r"(?<![\w:.])(?=[0-9a-fA-F]{0,4}:)(?=[a-fA-F:]*\d)(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?=[0-9a-fA-F:]*::)(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?)(?![\w:])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w+])(?:(?:\d{4}[ -]?){3}\d{4}|\d{4}[ -]?\d{6}[ -]?\d{5})(?!\w)",
    "national": r"(?<![\w+-])(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4})(?![\w-])",
    "phone": rf"(?<![\w+])(?<!\d[.,-])(?!{_DATE})(?:\+\d(?:{_STOP}[ ./()-]{{0,3}}\d){{6,14}}|(?=(?:[ ./()-]{{0,2}}\d){{7}})\(?0\d{{1,4}}\)?(?:{_STOP}[ ./-]{{1,2}}\d{{2,8}}){{1,5}}|\d{{3}}-\d{{4}}|\d{{10,15}}|{_GROUPS})(?!\w)",
    "person": rf"(?<!\w)(?=[{''.join(sorted({a[0] for a in _GENDER}))}])(?:(?:{TITLES})(?:[  ]+|(?<=\.)))+(?P<names>{_NAMED}(?:(?:[  ]+|(?<=\.))(?!(?:{TITLES})(?!\w)){_NAMED})*)",
}
_PERSON = re.compile(PATTERNS["person"])
# What a text must hold for a pattern to match: cheap to seek in its bytes.
_SEVEN_DIGITS = re.compile(rb"[0-9](?:[ ./()+-]{0,4}[0-9]){6}")
_DOTTED, _ACCOUNT = re.compile(rb"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"), re.compile(rb"[A-Z][A-Z][0-9][0-9]")
_IS_HEX = bytes(ord("h") if chr(c) in "0123456789abcdefABCDEF" else ord(" ") for c in range(256))
_LIMIT, _GIVEN_LIMIT = 12, 3
Piece = tuple[int, int, str, str]


def _script(word: str) -> str:
    c = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _bare_value(name: str) -> str:
    return unicodedata.normalize("NFC", name).replace("’", "'").lower()


def _name_parts(m: re.Match) -> list[list[Piece]]:
    """The capitalised parts of a name, each as its segments between hyphens: ``begin, end, "name" or "initial", value``."""
    text, stop, parts = m.string, m.end("names"), []
    found = [x for x in _SEGMENT.finditer(text, m.start("names"), stop) if x["segment"]]
    for x in found:
        hyphen = text[x.start() - 1] in "-‐‑"
        if not hyphen and (x.group()[0].islower() or parts and x.group() in _SUFFIXES):
            continue
        letter = len(_bare_value(x.group())) == 1 and (x is not found[-1] or text[x.end() : x.end() + 1] == "." and x.end() < stop)
        piece = (x.start(), x.end(), "initial" if letter else "name", _bare_value(x.group()))
        if hyphen and parts:
            parts[-1].append(piece)
        else:
            parts.append([piece])
    return parts


def _persons(matches: list[re.Match]) -> tuple[list[tuple[str, str, list[Piece]]], dict[str, str]]:
    """Type, value and pieces of each person of one text, and the kind of every name in it.

    The last part of several is the family name, the others are given names. A part that
    stands alone after its title is what it is in a longer name of the text, else a family name.
    """
    read, kinds, gendered = [], {}, {}
    for m in matches:
        titles = re.findall(TITLES, m.string[m.start() : m.start("names")])
        gender = next((g for t in titles if (g := _GENDER.get(t) or _GENDER[t.rstrip(".")]) != "u"), "u")
        read.append((gender, _name_parts(m)))
    for gender, parts in read:
        for n, part in enumerate(parts):
            for _, _, kind, value in part:
                if kind == "name" and len(parts) > 1:
                    role = "family" if n == len(parts) - 1 else f"given-{gender}"
                    kinds.setdefault(value, role)
                    if role in ("given-m", "given-f"):
                        gendered.setdefault(value, role)
    out = []
    for gender, parts in read:
        pieces = []
        for n, part in enumerate(parts):
            for begin, end, kind, value in part:
                if kind == "name" and len(parts) == 1:
                    kind = kinds.setdefault(value, "family")
                elif kind == "name":
                    kind = "family" if n == len(parts) - 1 else f"given-{gender}"
                pieces.append((begin, end, gendered.get(value, kind) if kind == "given-u" else kind, value))
        out.append((f"person-{gender}", " ".join("-".join(p[3] for p in part) for part in parts), pieces))
    return out, {v: gendered.get(v, k) if k == "given-u" else k for v, k in kinds.items()}


def possible(data: bytes, text: str) -> tuple[str, ...]:
    """The patterns that may match in a text; the others cannot."""
    digits = re.search(rb"[0-9]", data) is not None
    seven = digits and _SEVEN_DIGITS.search(data) is not None
    held = {
        "email": b"@" in data,
        "secret": b"h" * 32 in data.translate(_IS_HEX),
        "ip": digits and _DOTTED.search(data) is not None,
        "ipv6": digits and (b"::" in data or data.count(b":") >= 7),
        "iban": digits and _ACCOUNT.search(data) is not None,
        "card": seven,
        "national": seven,
        "phone": seven,
        "person": _PERSON.search(text) is not None,
    }
    return tuple(k for k in PATTERNS if held[k])


@cache
def _any_of(kinds: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?P<{k}>{PATTERNS[k]})" for k in kinds))


def found_in(text: str) -> list[tuple[int, int, str, str, list[Piece]]]:
    """Begin, end, type and value of what is found, and the pieces that get a surrogate each.

    A person is a name after a form of address, or a name of such a person that stands
    alone anywhere in the same text.
    """
    kinds, out, persons = possible(text.encode("utf-8", "replace"), text), [], []
    for m in _any_of(kinds).finditer(text) if kinds else ():
        kind, found, begin, end = m.lastgroup, m.group(), m.start(), m.end()
        if kind == "person":
            persons.append(m)
            continue
        if kind == "email":
            found = found.rstrip(".-")
            value, end = found.lower(), begin + len(found)
        elif kind in ("card", "phone", "national"):
            value = re.sub(r"\D", "", found)
        else:
            value = found.replace(" ", "").lower()
        out.append((begin, end, kind, value, [(begin, end, kind, value)]))
    if not persons:
        return out
    named, names = _persons(persons)
    out += [(p[0][0], p[-1][1], kind, value, p) for kind, value, p in named if p]
    out.sort()
    bare, at = [], 0
    spans = sorted([(m.start(), m.end()) for m in persons] + [(a, b) for a, b, kind, *_ in out if not kind.startswith("person")])
    for begin, end in [*spans, (len(text), len(text))]:
        for x in _BARE.finditer(text, at, begin):
            value = _bare_value(x.group())
            if len(value) > 1 and (kind := names.get(value)):
                gender = "u" if kind == "family" else kind[-1]
                bare.append((x.start(), x.end(), f"person-{gender}", value, [(x.start(), x.end(), kind, value)]))
        at = end
    return sorted(out + bare)


def entities(text: str) -> Iterable[tuple[int, int, str, str]]:
    """Begin, end, type and value of what is found: values are equal where the form alone differs."""
    for begin, end, kind, value, _ in found_in(text):
        yield begin, end, kind, value


class _Draw:
    """Numbers drawn from a key and what they are for."""

    def __init__(self, key: bytes, *about):
        self.key, self.about, self.turn, self.left = key, "|".join(map(str, about)).encode(), 0, 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            self.left = int.from_bytes(blake2b(self.about + self.turn.to_bytes(4, "big"), key=self.key).digest(), "big")
            self.turn += 1
        self.left, out = divmod(self.left, n)
        return out


def _like(c: str, draw: _Draw) -> str:
    """A character of the same kind: digit, script and case."""
    if c.isdigit():
        return str(draw.below(10))
    if not c.isalpha():
        return c
    first, n = ("а", 32) if _script(c) == "cyrillic" else ("α", 17) if _script(c) == "greek" else ("a", 26)
    new = chr(ord(first) + draw.below(n))
    return new.upper() if c.isupper() else new


def _luhn(digits: str) -> int:
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10


def _iban_rest(value: str) -> int:
    """The remainder that is 1 for a valid account number."""
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """The surrogate that a value gets at an attempt. After some, it may be longer than the value."""
    draw = _Draw(key, kind, value, attempt)
    longer = max(0, attempt - _LIMIT)
    if kind == "family":
        pool = SYLLABLES[_script(value)]
        return "".join(pool[draw.below(len(pool))] for _ in range(3 + longer))
    if kind.startswith("given"):
        script = _script(value)
        pool = [n for g in "mf" if kind[-1] in (g, "u") for n in GIVEN[script, g]]
        more = SYLLABLES[script]
        return pool[draw.below(len(pool))] + "".join(more[draw.below(len(more))] for _ in range(attempt - _GIVEN_LIMIT))
    if kind == "email":
        local, _, host = value.partition("@")
        *labels, top = host.split(".")
        local = "".join(_like(c, draw) for c in local + "a" * longer)
        labels = [x if x == "example" else "".join(_like(c, draw) for c in x) for x in labels]
        return f"{local}@{'.'.join([*labels, top])}"
    if kind == "ip":
        out = []
        for octet in value.split("."):
            low, high = {1: (1, 9), 2: (10, 99), 3: (100, 255)}[len(octet.lstrip("0") or "0")]
            out.append(str(low + draw.below(high - low + 1)))
        if longer:
            out = [str(draw.below(256)) for _ in range(4)]
        return ".".join(out)
    if kind == "ipv6":
        groups = ["".join("0123456789abcdef"[draw.below(16)] for _ in g) for g in value.split(":")]
        return ":".join(f"{draw.below(1 << 16):x}" for _ in range(8)) if longer else ":".join(groups)
    if kind == "secret":
        return "".join("0123456789abcdef"[draw.below(16)] for _ in value)
    if kind == "iban":
        checked = _iban_rest(value) == 1
        rest = "".join(_like(c, draw) for c in value[4 if checked else 2 :])
        return f"{value[:2]}{98 - _iban_rest(f'{value[:2]}00{rest}'):02}{rest}" if checked else value[:2] + rest
    digits = value[0] + "".join(str(draw.below(10)) for _ in value[1:]) + "".join(str(draw.below(10)) for _ in range(longer))
    if kind == "card" and _luhn(value) == 0:
        digits = next(d for d in (digits[:-1] + str(i) for i in range(10)) if _luhn(d) == 0)
    return digits


def initial(letter: str, key: bytes) -> str:
    """The initial that replaces one: another letter of its script, no two the same among the plain letters."""
    first, n = {"cyrillic": ("а", 32), "greek": ("α", 17), "latin": ("a", 26)}[_script(letter)]
    draw, letters = _Draw(key, "initial", first), [chr(ord(first) + i) for i in range(n)]
    for i in range(n - 1, 0, -1):  # one cycle through all letters, so that none stays
        j = draw.below(i)
        letters[i], letters[j] = letters[j], letters[i]
    return letters[(ord(letter[0]) - ord(first)) % n]


def dressed(found: str, kind: str, value: str) -> str:
    """A surrogate in the form of what it replaces: its separators and its case."""
    if kind == "family" or kind == "initial" or kind.startswith("given"):
        return value if found[0].islower() else value.upper() if found.isupper() and len(found) > 1 else value.capitalize()
    if kind in ("email", "ip", "ipv6"):
        return value.upper() if found.isupper() else value
    rest, out = iter(value), []
    for c in found:
        if not c.isalnum():
            out.append(c)
        elif (n := next(rest, None)) is not None:
            out.append(n.upper() if c.isupper() else n)
    out += list(rest)
    return "".join(out).upper() if kind in ("secret", "iban") and found.isupper() else "".join(out)


def _drawn(pending: DataFrame, key: bytes) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterable[tuple]:
        for kind, value, attempt in zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt"))):
            yield kind, value, attempt, surrogate(kind, value, attempt, key)

    return in_arrow(pending, rows, "kind string, value string, attempt int, surrogate string")


def assigned(values: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, surrogate`` of each distinct ``kind, value``: no two share a surrogate, and none is a value.

    Each round draws a surrogate for what has none yet. Where several drew the same,
    the first keeps it; the others, and those that drew a value of the table or a
    surrogate given before, draw again. Given and family names are one kind here.
    """
    group = lambda c: F.regexp_replace(c, "^(given.*|family)$", "name")
    taken = values.select(group("kind").alias("group"), F.col("value").alias("surrogate")).distinct()
    pending, done = values.withColumn("attempt", F.lit(0)), None
    while True:
        me = F.struct("attempt", "kind", "value")
        drawn = materialize(_drawn(pending, key).withColumn("group", group("kind")), "drawn")
        # The first of each surrogate by a partial minimum: many names draw one of few given names.
        first = materialize(drawn.groupBy("group", "surrogate").agg(F.min(me).alias("first")), "first")
        free = drawn.join(first, ["group", "surrogate"]).join(taken.withColumn("in_use", F.lit(True)), ["group", "surrogate"], "left")
        found = materialize(free.withColumn("kept", (F.col("first") == me) & F.col("in_use").isNull()).drop("first", "in_use"), "surrogates")
        kept = found.filter("kept")
        done = kept if done is None else done.unionByName(kept)
        pending = found.filter("not kept").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done.select("kind", "value", "surrogate")
        taken = taken.unionByName(kept.select("group", "surrogate"))


def replace_personal(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, text, n_entities, text_sha256``, with personal data replaced.

    Mail addresses, IP addresses, phone, card, account and social security numbers, long hexadecimal
    secrets and names after a form of address become surrogates of the same type,
    drawn from a key: digits for digits, letters of the same script and case, valid
    card check digits for valid ones, given names of the same gender. A value has
    one surrogate in the whole table, in whatever form it is written, and no two
    values share one. Each given and family name is a value, so a family name alone, and
    a name repeated in the same text without a title, follow the full name. A given name
    after a title of no gender follows the same name after one that tells it. An
    initial becomes another letter, the same in the whole table.

    A row is read twice: once for the values in it, and once to pass it through if it has none; only rows
    with values are written and shuffled. Distinct values are found by partial counts, so one value
    may stand in any share of the rows. A NULL text stays NULL with the digest of an
    empty one; empty texts, NULL and repeated ids pass through. Repeated rows are replaced alike.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def found(batch: pa.RecordBatch) -> Iterable[tuple]:
        for part in sliced(batch, "text"):
            for i, text in zip(part.column("id").to_pylist(), raw(part, "text")):
                held = found_in(text.decode("utf-8", "replace"))
                if held:
                    seen = sorted({(k, v) for *_, pieces in held for _, _, k, v in pieces if k != "initial"})
                    yield i, text, [{"kind": k, "value": v} for k, v in seen]

    schema = "id long, text binary, seen array<struct<kind: string, value: string>>"
    hits = materialize(in_arrow(named, found, schema, 1000).withColumn("row", F.monotonically_increasing_id()), "personal")
    each = hits.select("row", F.explode("seen").alias("e")).select("row", "e.kind", "e.value")
    values = each.select("kind", "value").distinct()
    told = values.filter("kind IN ('given-m', 'given-f')").groupBy(F.col("value").alias("told_value")).agg(F.min("kind").alias("told"))
    same = (F.col("kind") == "given-u") & (F.col("value") == F.col("told_value"))
    asked = materialize(values.join(told, same, "left").select("kind", "value", F.coalesce("told", "kind").alias("as_kind")), "asked")
    drawn = assigned(asked.select(F.col("as_kind").alias("kind"), "value").distinct(), key).withColumnRenamed("kind", "as_kind")
    given = materialize(asked.join(drawn, ["as_kind", "value"]).select("kind", "value", "surrogate"), "given")
    by_row = each.join(given, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("given"))

    def replaced(batch: pa.RecordBatch) -> Iterable[tuple]:
        for i, text, given_ in zip(batch.column("id").to_pylist(), raw(batch, "text"), batch.column("given").to_pylist()):
            new, parts, at, n = {(g["kind"], g["value"]): g["surrogate"] for g in given_ or []}, [], 0, 0
            whole = text.decode("utf-8", "replace")
            for *_, pieces in found_in(whole):
                n += 1
                for a, b, kind, value in pieces:
                    to = initial(value, key) if kind == "initial" else new[kind, value]
                    parts += [whole[at:a], dressed(whole[a:b], kind, to)]
                    at = b
            yield i, "".join([*parts, whole[at:]]), n

    changed = in_arrow(hits.select("row", "id", "text").join(by_row, "row", "left"), replaced, "id long, text string, n_entities long", 1000)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                yield part.filter(pa.array([not found_in(t.decode("utf-8", "replace")) for t in raw(part, "text")], pa.bool_()))

    plain = named.mapInArrow(untouched, named.schema).withColumn("n_entities", F.lit(0).cast("long"))
    out = changed.unionByName(plain)
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_entities", F.sha2(text_of("text"), 256).alias("text_sha256"))
