"""PII surrogates: detected entities get keyed replacements of their own kind.

Detected are e-mail addresses, telephone numbers, payment cards, IPv4 addresses, social
security numbers, IBANs, secrets (keys, tokens, passwords behind their name) and personal
names behind a title, and the words of such a name wherever else they stand in the same
document with a capital (unless they stand there in lower case too, or are one letter).
Names that no title in their document tells are not detected. An entity is its type and its canonical form (case, spaces and
punctuation taken away where they do not count), so that one person written in two ways
stays one.

A surrogate is drawn from HMAC-SHA256 over type, canonical form and attempt, and keeps what
the kind demands: country code and grouping of a number, network and check digit of a card,
script, case and length of letters, gender of a given name. E-mail domains become names
under ``.example``, IPv4 addresses stay in 10.0.0.0/8.

Distinct entities must stay distinct and must not become each other: over all entities of
the corpus, surrogates are grouped, of those that clash one stays (the least entity), none
may be a value that occurs as an original, and the others draw again, until none is left.
Then blocks of documents fetch the surrogates of their entities (one row a block and
entity, however often it stands there) and are rewritten. Texts without an entity never
leave their task.

Defined cases: a null text stays null, an empty one empty; a secret without a letter or
digit (``password=********``) is masked already and no entity; repeated rows get the same
result; an entity that stands in a third of all documents is one row a block; an empty table
gives an empty result; all other columns ride along in ``carry``.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import has_rows, of_worker, ship, written

KEY = b"rowferry-surrogates"  # give your own: with it, surrogates can be recomputed
BLOCK_ROWS = 256
BLOCK_BYTES = 2 << 20

# fixed values: titles by the gender they tell, given names by gender, and syllables to build names from
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Lord"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Lady"),
    "n": ("Dr", "Prof", "Mx"),
}
GIVEN = {
    "m": ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Peter", "Paul",
          "Hans", "Karl", "Jürgen", "Klaus", "Stefan", "Pierre", "Jean", "Michel", "Jacques", "Luc", "Juan", "José", "Carlos", "Luis", "Miguel"),
    "f": ("Mary", "Patricia", "Linda", "Barbara", "Elizabeth", "Jennifer", "Susan", "Sarah", "Karen", "Anna", "Emma", "Laura", "Julia",
          "Ursula", "Monika", "Petra", "Sabine", "Marie", "Sophie", "Camille", "Claire", "María", "Carmen", "Ana", "Lucía", "Elena"),
}
STARTS = "Al Ber Cal Dor El Fen Gar Hal Is Jor Kel Lor Mar Nor Or Per Ros Sel Tal Ver Wil".split()
MIDDLES = "a be da e fi ga i ka le mi na o pe ra se ta u ve".split()
GIVEN_ENDS = {"m": "n rd s t us".split(), "f": "a ia elle ine na".split(), "n": "is ry en el".split()}
SURNAME_ENDS = "berg er feld ham ler man sen son ton well".split()

_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_GIVEN_GENDER = {n.casefold(): g for g, ns in GIVEN.items() for n in ns}
_WORD = r"[^\W\d_]"
_NAME = rf"(?:(?!(?:{'|'.join(_TITLE_GENDER)})\b){_WORD}+(?:[-'’]{_WORD}+)*)"
_TOKEN = re.compile(rf"{_WORD}+(?:[-'’]{_WORD}+)*")
PATTERN = re.compile(
    "|".join((
        r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?![\w@-]))",
        r"(?P<secret>\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{30,}\b|\bsk-[A-Za-z0-9_-]{20,}"
        r"|(?<=password=)[^\s\"']{6,}|(?<=token=)[^\s\"']{8,}|(?<=token = \")[^\s\"]{8,}|(?<=secret=)[^\s\"']{6,}|(?<=secret = \")[^\s\"]{6,}"
        r"|(?<=api_key=)[^\s\"']{8,}|(?<=api_key = \")[^\s\"]{8,}|(?<=password = \")[^\s\"]{6,})",
        r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b)",
        r"(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))",
        r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\w|\.[0-9]))",
        r"(?P<card>(?<![\w+.-])[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\w-]))",
        r"(?P<phone>(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,5}\)[ .-]?)[0-9]{2,8}(?:[ .-][0-9]{2,5}){0,4}(?!\w)"
        r"|(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,5}){2,6}(?!\w)|(?<![\w.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-]))",
        rf"(?P<name>\b(?:{'|'.join(sorted(_TITLE_GENDER, key=len, reverse=True))})\b\.?(?: {_NAME}){{1,3}})",
    ))
)
# no entity without one of these; most texts end here
_MAYBE = re.compile(rf"[0-9@]|AKIA|gh[pousr]_|sk-|password|token|secret|api_key|\b(?:{'|'.join(_TITLE_GENDER)})\b")


class Draw:
    """Numbers below a bound, from a keyed stream."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.label, self.at = key, "\0".join(parts).encode("utf-8", "surrogatepass"), 0
        self.pool = 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 64:
            self.pool = int.from_bytes(hmac.new(self.key, self.label + self.at.to_bytes(4, "big"), hashlib.sha256).digest(), "big")
            self.left, self.at = 256, self.at + 1
        self.pool, out = divmod(self.pool, n)
        self.left -= n.bit_length()
        return out


def luhn(digits: str) -> int:
    """The sum that is 0 modulo 10 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


# fixed values: the letters of a script, lower and upper
ALPHABETS = tuple(
    (low, low.upper())
    for low in ("abcdefghijklmnopqrstuvwxyz", "àáâãäåæçèéêëìíîïñòóôõöøùúûüý", "абвгдежзийклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω")
)


def like(text: str, draw: Draw, hexed: bool = False) -> str:
    """Another text of the same shape: a digit for a digit, a letter for a letter of its case and script."""
    out = []
    for c in text:
        if c.isdecimal():
            out.append(chr(ord(c) - int(c) + draw.below(10)))
        elif hexed and c in "abcdef":
            out.append("abcdef"[draw.below(6)])
        else:
            for low, up in ALPHABETS:
                if c in low:
                    out.append(low[draw.below(len(low))])
                    break
                if c in up:
                    out.append(up[draw.below(len(up))])
                    break
            else:  # letters of other scripts move within their block of sixteen
                out.append(chr(ord(c) & ~15 | draw.below(16)) if c.isalpha() and chr(ord(c) & ~15).isalpha() and chr(ord(c) | 15).isalpha() else c)
    return "".join(out)


def canonical(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card", "ssn"):
        return ("+" if text[0] == "+" else "") + re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return text.casefold() if kind.startswith(("given", "surname")) else text


def surrogate(kind: str, value: str, attempt: int, key: bytes = KEY) -> str:
    """The replacement of a canonical form; further attempts give others of the same kind."""
    draw = Draw(key, kind, value, str(attempt))
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        more = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 4))
        return f"{like(local, draw)}{more}@{like(domain.rsplit('.', 1)[0], draw)}.example"
    if kind == "ip":
        return f"10.{draw.below(256)}.{draw.below(256)}.{draw.below(256)}"
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[2:])
        want = luhn(value)
        return next(body + d for d in "0123456789" if luhn(body + d) == want)
    if kind == "phone":
        plus = value[0] == "+"
        # country code and the exchange kept for fiction stay
        keep = 2 if plus and value[1] in "17" else 3 if plus else 0
        out = list(value[:keep])
        for i, _ in enumerate(value[keep:]):
            if value[keep + 3 : keep + 6] == "555" and 3 <= i < 6:
                out.append("5")
            else:
                out.append(str(draw.below(8) + 2 if i in (0, 3) else draw.below(10)))
        return "".join(out)
    if kind == "ssn":
        return f"9{draw.below(100):02d}{draw.below(100):02d}{draw.below(10000):04d}"  # 9xx is never given out
    if kind == "iban":
        head, body = value[:2], like(value[4:], draw)
        number = int("".join(str(int(c, 36)) for c in body + head + "00"))
        return f"{head}{98 - number % 97:02d}{body}"
    if kind == "secret":
        start = 4 if re.match(r"AKIA|gh[pousr]_", value) else 3 if value.startswith("sk-") else 0
        # some letters have no others of their shape, and short secrets few: later attempts are longer
        more = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 4))
        return value[:start] + like(value[start:], draw, hexed=re.fullmatch(r"[0-9a-f]+", value) is not None) + more
    part, gender, script = kind.split(":")
    if script != "latin":
        return like(value, draw) + "".join(value[draw.below(len(value))] for _ in range(attempt // 4))
    middle = "".join(MIDDLES[draw.below(len(MIDDLES))] for _ in range(1 + attempt // 2 + (part == "surname")))
    ends = SURNAME_ENDS if part == "surname" else GIVEN_ENDS[gender]
    return (STARTS[draw.below(len(STARTS))] + middle + ends[draw.below(len(ends))]).casefold()


def dress(kind: str, original: str, new: str) -> str:
    """The canonical surrogate in the format of what it replaces."""
    if kind in ("phone", "card", "ssn", "iban"):
        signs, out = iter(new.removeprefix("+") if kind == "phone" else new), []
        for c in original:
            out.append(next(signs, "") if c.isalnum() else c)
        return "".join(out) + "".join(signs)
    if kind.startswith(("given", "surname")):
        return new.upper() if original.isupper() and len(original) > 1 else "-".join(p.capitalize() for p in new.split("-"))
    if kind == "email" and original.isupper():
        return new.upper()
    return new


def _script(word: str) -> str:
    return "latin" if all(ord(c) < 0x250 for c in word) else "other"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and text of each entity; the words of a name are entities of their own."""
    out = []
    if not _MAYBE.search(text):
        return out
    for m in PATTERN.finditer(text):
        kind, a, b = m.lastgroup, m.start(), m.end()
        if kind == "phone" and not 7 <= sum(c.isdigit() for c in m.group()) <= 15:
            continue
        if kind == "card" and not 13 <= sum(c.isdigit() for c in m.group()) <= 19:
            continue
        if kind == "secret" and not any(map(str.isalnum, m.group())):
            continue
        if kind != "name":
            out.append((a, b, kind, m.group()))
            continue
        words = list(re.finditer(r"[^ ]+", m.group()))
        gender, names = _TITLE_GENDER[words[0].group().rstrip(".")], []
        for w in words[1:]:
            if not w.group()[0].isupper():
                break
            names.append(w)
        for i, w in enumerate(names):
            word = w.group()
            if i < len(names) - 1:
                sex = _GIVEN_GENDER.get(word.casefold(), gender)
                out.append((a + w.start(), a + w.end(), f"given:{sex}:{_script(word)}", word))
            else:
                out.append((a + w.start(), a + w.end(), f"surname:n:{_script(word)}", word))
    return _bare(text, out)


def _bare(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """``found`` and, between them, the words of the names in it without their title."""
    names: dict[str, str] = {}
    for _, _, kind, word in found:
        if kind.startswith(("given", "surname")) and len(word) > 1:
            names.setdefault(word.casefold(), kind)
    if not names:
        return found
    words, at = [], 0
    for a, b in [*((a, b) for a, b, _, _ in found), (len(text), len(text))]:
        words += [(m.start(), m.group()) for m in _TOKEN.finditer(text, at, a)]
        at = b
    words = [(a, w if w.casefold() in names else re.sub(r"['’][sS]$", "", w)) for a, w in words]
    plain = {w for _, w in words if w.islower()}
    more = [(a, a + len(w), names[w.casefold()], w) for a, w in words if w[0].isupper() and w.casefold() in names and w.lower() not in plain]
    return sorted([*found, *more])


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            kinds, values, tries = (part.column(c).to_pylist() for c in ("kind", "value", "attempt"))
            new = [surrogate(k, v, n, key) for k, v, n in zip(kinds, values, tries, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(new, pa.string())], names=[*part.schema.names, "surrogate"])

    return run


def assign(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, value)`` to ``(kind, value, surrogate)``: one to one within a kind, and none an original of it.

    Kinds of names clash across genders too, so the first word of a kind is what counts.
    """
    family = F.substring_index("kind", ":", 1)
    found = written(found.distinct(), "pii-entities")
    originals = found.select(family.alias("family"), F.col("value").alias("surrogate"))
    settled, attempt = None, 0
    open_ = found.withColumn("attempt", F.lit(0))
    while True:
        drawn = open_.mapInArrow(_drawn(key), "kind string, value string, attempt int, surrogate string").withColumn("family", family)
        drawn = written(drawn, "pii-drawn")
        free = drawn.join(originals, ["family", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("family", "surrogate"), ["family", "surrogate"], "left_anti")
        first = free.groupBy("family", "surrogate").agg(F.min(F.struct("kind", "value")).alias("w"))
        won = written(first.select("family", "surrogate", "w.kind", "w.value"), "pii-settled")
        settled = won if settled is None else settled.union(won)
        attempt += 1
        open_ = drawn.join(won.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value", F.lit(attempt).alias("attempt"))
        if not has_rows(open_):
            return settled.select("kind", "value", "surrogate")


def _with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with an entity, in blocks of bounded size."""
    of_worker("pii", dict)
    block, rows, size = TaskContext.get().partitionId() << 32, 0, 0
    for part in batches:
        keep, ids = [], []
        for i, text in enumerate(part.column("text").to_pylist()):
            if text and entities(text):
                if rows >= BLOCK_ROWS or (size and size + len(text) > BLOCK_BYTES):
                    block, rows, size = block + 1, 0, 0
                rows, size = rows + 1, size + len(text)
                keep.append(i)
                ids.append(block)
        if keep:
            got = part.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*got.columns, pa.array(ids, pa.int64())], names=["carry", "text", "block"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        keep = [i for i, text in enumerate(part.column("text").to_pylist()) if not (text and entities(text))]
        got = part.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*got.columns, pa.array([0] * len(keep), pa.int64())], names=["carry", "text", "n_entities"])


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        found = {(b, k, canonical(k, s)) for b, t in zip(*(part.column(c).to_pylist() for c in ("block", "text")), strict=True) for _, _, k, s in entities(t)}
        if found:
            b, k, v = zip(*sorted(found), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(k), pa.array(v)], names=["block", "kind", "value"])


def rewrite(text: str, new: dict[tuple[str, str], str]) -> tuple[str, int]:
    """The text with its surrogates, and how many entities it had."""
    out, at, n = [], 0, 0
    for a, b, kind, s in entities(text):
        out += [text[at:a], dress(kind, s, new[kind, canonical(kind, s)])]
        at, n = b, n + 1
    return "".join([*out, text[at:]]), n


def _apply(docs: pa.Table, fetched: pa.Table) -> pa.Table:
    new = dict(zip(zip(fetched.column("kind").to_pylist(), fetched.column("value").to_pylist(), strict=True), fetched.column("surrogate").to_pylist(), strict=True))
    texts = [rewrite(t, new) for t in docs.column("text").to_pylist()]
    return pa.Table.from_arrays(
        [docs.column("carry"), pa.array([t for t, _ in texts], pa.string()), pa.array([n for _, n in texts], pa.int64())], names=["carry", "text", "n_entities"]
    )


def replace_entities(docs: DataFrame, text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """``carry`` (all other columns), ``text`` with surrogates, ``n_entities``."""
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("carry"), F.col(text_col).alias("text"))
    carry = rows.schema["carry"].dataType.simpleString()
    blocks = written(rows.mapInArrow(_with, f"carry {carry}, text string, block long"), "pii-blocks")
    listed = written(blocks.select("block", "text").mapInArrow(_list, "block long, kind string, value string").distinct(), "pii-listed")
    mapping = assign(listed.select("kind", "value"), key)
    fetched = listed.join(mapping, ["kind", "value"]).select("block", "kind", "value", "surrogate")
    out = f"carry {carry}, text string, n_entities long"
    done = blocks.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(_apply, out)
    return rows.mapInArrow(_without, out).union(done)
