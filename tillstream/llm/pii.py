"""Personal data replaced by surrogates of the same kind.

An entity is found by its format, brought to a canonical form, and replaced by a surrogate that
a keyed hash of type and canonical form chooses: the same entity gets the same surrogate in every document.
Surrogates keep format (length, separators, letter case, script), and names keep the gender of their title. Given and
family names are entities of their own, so all spellings of a person's name share their surrogates.
Over all documents together, no two entities share a surrogate and no surrogate is an entity that
occurs: whoever collides tries its next surrogate, until nobody does.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import common

#: The key of the default query; a deployment passes its own secret.
DEMO_KEY = b"tillstream"

#: Entities that need another than their first surrogate are broadcast up to this number, beyond it
#: they are joined to their documents.
BROADCAST_ROWS = 200_000

#: Tries with the same length, after which a surrogate grows by one character for each further try
#: (an address takes octets of any length).
SAME_LENGTH_TRIES = 16

_TITLES = {
    "m": ("Mr", "Herr", "Sr", "Señor", "Monsieur", "Don", "Господин", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Madame", "Mme", "Doña", "Госпожа", "г-жа"),
}
_GENDER = {t: g for g, titles in _TITLES.items() for t in titles}

#: Given names by gender and script.
_GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Ida Julia Karin Laura Maria Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лидия Мария Нина Ольга".split(),
}
#: Syllables family names are made of, by script.
_SYLLABLES = {
    "latin": "ba bel bor da den dor fa fer gal gor ha hel ka kor la len lor ma mel nor ra ren sa sor ta ter va vel".split(),
    "cyrillic": "ба бел бор да ден дор га гор ка кор ла лен лор ма мел нор ра рен са сор та тер ва вел".split(),
}

_WORD = r"[^\W\d_][^\W\d_]*(?:['’-][^\W\d_]+)*"
#: Words inside a family name that stay as they are.
_PARTICLES = frozenset("de del della di da dos du la le van von der den ten ter zu zur af av bin ibn al el фон де".split())
_TITLE = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_POSSESSIVE = re.compile(r"['’][sS]$")
#: Behind a name without a family name, in its canonical form.
_NO_FAMILY = "~"
#: Phone numbers: behind a plus, with an area in brackets, in groups, or ten to twelve digits in a row. Dates, spans of
#: years and the digits of decimal fractions are none.
_SEP = "[ .\\-/\u00a0\u2011]"
_PHONE = (
    rf"(?<!\w)\+\(?(?:\d{{10,15}}|\d{{7,9}}(?!{_SEP}?\d)"
    rf"|\d{{1,9}}\)?(?:{_SEP}?\(0\){_SEP}?\d{{2,10}}|(?:{_SEP}|[()]){{1,3}}\d{{2,10}}){{1,6}})(?!\d)"
    rf"|(?<!\w)(?:\d{{1,3}}{_SEP}?)?\(\d{{2,5}}\){_SEP}{{0,2}}\d{{2,10}}(?:{_SEP}\d{{2,8}}){{0,4}}(?!\d)"
    r"|(?<!\w)(?<!\d[-./])(?!(?:19|20)\d\d[-./](?:0?[1-9]|1[0-2])[-./]\d{1,2}(?!\d))"
    r"(?!\d{1,2}[-./]\d{1,2}[-./](?:19|20)\d\d(?!\d))(?!(?:19|20)\d\d[-/](?:19|20)\d\d(?![-\d]))"
    rf"(?:(?:\d[-.])?\d{{2,5}}(?:[ \-/\u00a0\u2011]\d{{2,10}}|\.\d{{2,4}}){{1,5}}(?!\d)|\d{{10,12}}(?!\w|\.\d))"
)
_PATTERNS = {
    "email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?i:\b(?:api[_-]?key|token|secret|password|passwd|pwd)\b\s*[:=]\s*[\"']?)(?P<secret_value>[\w./+=-]{8,})",
    "key": r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9]{20,}|xox[baprs]-[A-Za-z0-9-]{10,})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)",
    "ip6": r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]*\d)",
    "phone": _PHONE,
    "name": rf"(?<!\w)(?P<name_title>{_TITLE})\.? (?P<name_value>(?!(?:{_TITLE})\b){_WORD}(?: (?!(?:{_TITLE})\b){_WORD})*)",
}
#: Numbers in the groups of a payment card; found first where the check digit is right.
_CARD_GROUPS = r"(?<![\d-])(?:\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}(?P<gap2>[ -]?)\d{6}(?P=gap2)\d{5})(?![\d-]*\d)"
#: What a number or a name could swallow a part of is looked for first, these then only in what is left.
_LATER = ("ssn", "card", "phone", "name")
#: Longer runs of digits that look like a card and nothing else.
_ONLY_CARD = re.compile(r"\d+|(?:\d{4}[ -]){2,4}\d{1,4}")


def _any_of(patterns: dict[str, str]) -> re.Pattern:
    return re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in patterns.items()))


_FIRST = _any_of({k: p for k, p in _PATTERNS.items() if k not in _LATER} | {"card": _CARD_GROUPS})
_REST = _any_of({k: _PATTERNS[k] for k in _LATER})
_PHONES = _any_of({"phone": _PHONE})
_HINT = re.compile(r"[\d@:=]")


def find(text: str) -> list[tuple[int, int, str, str, str]]:
    """``start, end, type, canonical form, gender`` of the entities of a text, in order, not overlapping.

    Names are those behind a title: all words that begin with a capital letter, with particles before and between
    them; and wherever their words stand in the same text without a title, beginning with a capital letter.
    """
    if not _HINT.search(text) and not any(t in text for t in _GENDER):
        return []
    found = _matches(_FIRST, text, 0, len(text))
    gaps = zip([0, *[f[1] for f in found]], [*[f[0] for f in found], len(text)])
    for begin, end in list(gaps):
        found += _matches(_REST, text, begin, end)
    found.sort()
    return _with_mentions(text, found)


def _matches(pattern: re.Pattern, text: str, begin: int, stop: int) -> list[tuple[int, int, str, str, str]]:
    """Entities of some kinds between two places. A card has a right check digit; a run of digits like one that has none is nothing."""
    found, at = [], begin
    while m := pattern.search(text, at, stop):
        kind, gender = next(k for k in _PATTERNS if k in pattern.groupindex and m.group(k) is not None), ""
        start, end = m.span(f"{kind}_value") if kind in ("secret", "name") else m.span()
        at = max(m.end(), at + 1)
        if kind == "card" and _luhn(canonical(kind, text[start:end])):
            # no card, but perhaps numbers side by side
            m = None if _ONLY_CARD.fullmatch(text, start, end) else _PHONES.search(text, start, stop)
            if m is None or m.start() >= end:
                continue
            kind, (start, end) = "phone", m.span()
            at = end
        if kind == "name":
            size = _name_length(text[start:end])
            if not size:
                continue
            end, gender = start + size, _GENDER[m.group("name_title")]
        value = text[start:end]
        if kind == "phone" and sum(c.isdigit() for c in value) < 7:
            continue
        found.append((start, end, kind, canonical(kind, value, gender), gender))
    return found


def _name_length(value: str) -> int:
    """How much of the words behind a title is a name: up to the last word with a capital letter before one
    that has none and is no particle, or up to a possessive ending, without it. 0: there is none."""
    size = at = 0
    for word in value.split(" "):
        if word[0].isupper() and word.lower() not in _GENDER:
            own = _POSSESSIVE.search(word) if len(word) > 2 else None
            size = at + (own.start() if own else len(word))
            if own:
                break
        elif word.lower() not in _PARTICLES:
            break
        at += len(word) + 1
    return size


def _is_particle(word: str, words: list[str]) -> bool:
    return word in _PARTICLES and len(words) > 1


def parts(kind: str, entity: str) -> list[tuple[str, str]]:
    """What an entity draws surrogates for: itself, or its given and family names. Particles are left out."""
    if kind != "name":
        return [(kind, entity)]
    gender, _, full = entity.partition(":")
    words = full.split(" ")
    last = len(words) - 1
    return [
        ("family", w) if i == last else ("given", f"{gender}:{w}")
        for i, w in enumerate(words)
        if w != _NO_FAMILY and (i == last or not _is_particle(w, words))
    ]


def _with_mentions(text: str, found: list[tuple[int, int, str, str, str]]) -> list[tuple[int, int, str, str, str]]:
    """Also the names of ``found`` where they stand without a title."""
    given, family = {}, {}
    for _, _, kind, entity, gender in found:
        if kind == "name":
            for part, word in parts(kind, entity):
                (family if part == "family" else given).setdefault(word.rpartition(":")[2], gender)
    if not family:
        return found
    words = sorted({*given, *family}, key=len, reverse=True)
    known = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)", re.IGNORECASE)
    taken, at, runs = found, 0, []
    for m in known.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if not m[0][0].isupper() or (at < len(taken) and taken[at][0] < end):
            continue
        between = text[runs[-1][1] : start] if runs else ""
        joined = between[:1] == " " and all(w in _PARTICLES for w in between[1:-1].split(" ") if w) and between[-1:] == " "
        if runs and joined and not runs[-1][2] and not (at and taken[at - 1][0] >= runs[-1][1]):
            runs[-1][1:] = end, m[0].lower() in family
        else:
            runs.append([start, end, m[0].lower() in family])
    for start, end, whole in runs:
        low = text[start:end].lower()
        first, last = low.split(" ")[0], low.split(" ")[-1]
        gender = given.get(first) or family.get(last) or next(iter(family.values()))  # case folds in odd ways
        found = [*found, (start, end, "name", f"{gender}:{low}" + ("" if whole else f" {_NO_FAMILY}"), gender)]
    return sorted(found)


def canonical(kind: str, value: str, gender: str = "") -> str:
    """One form for all spellings of an entity: lower case, and numbers without separators (their
    places are kept apart, for a surrogate keeps them)."""
    if kind in ("card", "phone", "iban"):
        return re.sub(r"[^\w+]", "", value).upper()
    if kind in ("secret", "key"):
        return value
    low = value.lower()
    return f"{gender}:{low}" if kind == "name" else low


class _Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *about: str) -> None:
        self.seed, self.at, self.pool = hmac.new(key, "\0".join(about).encode("utf-8", "surrogatepass"), hashlib.sha256), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            one = self.seed.copy()
            one.update(self.at.to_bytes(4, "big"))
            self.pool, self.at = one.digest(), self.at + 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n


def _luhn(digits: str) -> int:
    double = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in double) % 10


def _script(word: str) -> str:
    return "cyrillic" if any("\u0400" <= c <= "\u04ff" for c in word) else "latin"


def _like(c: str, draw: _Draw, hexadecimal: bool = False) -> str:
    """Another character of the same kind and case."""
    if c.isdigit():
        return str(draw.below(10))
    if not c.isalpha():
        return c
    letters = "abcdef" if hexadecimal else ("абвгдежзиклмнопрст" if _script(c) == "cyrillic" else "abcdefghijklmnopqrstuvwxyz")
    new = letters[draw.below(len(letters))]
    return new.upper() if c.isupper() else new


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate of a canonical entity, in canonical form."""
    draw = _Draw(key, kind, entity, str(attempt))
    longer = max(0, attempt - SAME_LENGTH_TRIES)
    if kind == "given":
        gender, _, word = entity.partition(":")
        script = _script(word)
        known, syllables = _GIVEN[(gender, script)], _SYLLABLES[script]
        new = known[draw.below(len(known))].lower()
        more = 1 + attempt // 4 if attempt else 0  # the known ones are few
        return f"{gender}:{new}" + "".join(syllables[draw.below(len(syllables))] for _ in range(more))
    if kind == "family":
        syllables = _SYLLABLES[_script(entity)]
        return "".join(syllables[draw.below(len(syllables))] for _ in range(3 + attempt // 4))
    if kind == "email":
        local, _, domain = entity.partition("@")
        head, dot, top = domain.rpartition(".")
        own = _Draw(key, "domain", domain)  # people of one domain stay together
        new = "".join(_like(c, draw) for c in local) + "".join(_like("a", draw) for _ in range(longer))
        return f"{new}@{''.join(_like(c, own) for c in head)}{dot}{top}"
    if kind == "ip":
        bounds = {1: (0, 10), 2: (10, 100), 3: (100, 256)}
        spans = [(0, 256) if longer else bounds[len(str(int(o)))] for o in entity.split(".")]
        return ".".join(str(low + draw.below(high - low)) for low, high in spans)
    if kind == "card":
        body = "".join(_like(c, draw) for c in entity[:-1])
        right = (10 - _luhn(body + "0")) % 10
        return body + str(right if _luhn(entity) == 0 else (right + 1 + draw.below(9)) % 10)
    if kind == "iban":
        body = "".join(_like(c, draw) for c in entity[4:])
        number = int("".join(str(int(c, 36)) for c in body + entity[:2] + "00"))
        return f"{entity[:2]}{98 - number % 97:02d}{body}"
    if kind == "ssn":
        return "".join(_like(c, draw) for c in entity + "0" * longer)
    if kind == "phone":
        kept = 2 if entity.startswith("+") else 0
        return entity[:kept] + "".join(_like(c, draw) for c in entity[kept:] + "0" * longer)
    if kind == "key":  # the maker's mark stays
        return entity[:4] + "".join(_like(c, draw) for c in entity[4:]) + "".join(_like("a", draw) for _ in range(longer))
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in entity if c.isalnum())
    return "".join(_like(c, draw, hexadecimal) for c in entity) + "".join(_like("a", draw, True) for _ in range(longer))


def _shown(kind: str, value: str, new: str) -> str:
    """A canonical surrogate in the spelling of the value it replaces."""
    if kind in ("card", "phone", "iban"):
        rest = iter(new)
        out = "".join(c if not (c.isalnum() or c == "+") else next(rest, "") for c in value)
        return out + "".join(rest)
    if kind == "email":
        if value.isupper():
            return new.upper()
        same = len(new) == len(value)
        return "".join(n.upper() if same and o.isupper() else n for o, n in zip(value, new, strict=same)) if same else new
    return new


def _renamed(value: str, entity: str, new: list[str]) -> str:
    """A name in its spelling with the surrogates of its parts; particles stay."""
    words, rest = entity.partition(":")[2].split(" "), iter(new)
    out = []
    for i, old in enumerate(value.split(" ")):
        if i < len(words) - 1 and _is_particle(words[i], words):
            out.append(old)
        else:
            w = next(rest).rpartition(":")[2]
            out.append(w.upper() if len(old) > 1 and old.isupper() else w.capitalize())
    return " ".join(out)


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {x for t in common.texts_of(batch) for e in find(t) for x in parts(e[2], e[3])}
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.string()), pa.array([e for _, e in rows], pa.string())], ["kind", "entity"]
        )


def _drawn(key: bytes):
    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            new = [surrogate(key, k, e, n) for k, e, n in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    return drawn


def attempts(docs: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, attempt, new`` of all different entities of ``docs.text``.

    Of entities with one surrogate the first in order keeps it; one whose surrogate occurs as an entity gives it up.
    """
    found = docs.select("text").mapInArrow(_entities, "kind string, entity string").distinct()
    table = common.stage(found.withColumn("attempt", F.lit(0)), "entities")
    real = table.select("kind", F.col("entity").alias("new")).withColumn("real", F.lit(True))
    while True:
        drawn = common.stage(
            table.mapInArrow(_drawn(key), "kind string, entity string, attempt int, new string"), "surrogates"
        )
        first = drawn.groupBy("kind", "new").agg(F.min("entity").alias("first"))
        judged = (
            drawn.join(first, ["kind", "new"])
            .join(real, ["kind", "new"], "left")
            .withColumn("again", (F.col("entity") != F.col("first")) | F.col("real").isNotNull())
        )
        judged = common.stage(judged.select("kind", "entity", "attempt", "new", "again"), "collisions")
        if judged.filter("again").isEmpty():
            return drawn
        table = judged.select("kind", "entity", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


def _replaced(key: bytes, given):
    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = given()
        for batch in batches:
            names = batch.schema.names
            own = batch.column(names.index("later")).to_pylist() if "later" in names else [None] * batch.num_rows
            texts, counts, kinds = [], [], []
            for text, later in zip(common.texts_of(batch), own, strict=True):
                tries = everywhere if later is None else {(x["kind"], x["entity"]): x["attempt"] for x in later}
                out, at, found = [], 0, find(text)
                for start, end, kind, entity, _ in found:
                    new = [surrogate(key, *x, tries.get(x, 0)) for x in parts(kind, entity)]
                    old = text[start:end]
                    out += [text[at:start], _renamed(old, entity, new) if kind == "name" else _shown(kind, old, new[0])]
                    at = end
                texts.append("".join([*out, text[at:]]))
                counts.append(len(found))
                kinds.append(",".join(sorted({f[2] for f in found})))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts), pa.array(counts, pa.int64()), pa.array(kinds)],
                ["row", "text", "n_entities", "kinds"],
            )

    return replaced


def replace(docs: DataFrame, key: bytes = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, text, n_entities, kinds``, the text with surrogates.

    A null text counts as empty and has none. Repeated rows and null ids are treated like any other.
    ``kinds`` are the types found, sorted, with commas between.
    """
    spark = docs.sparkSession
    rows = common.id_text(docs, id_col, text_col)
    later = common.stage(attempts(rows, key).filter("attempt > 0").select("kind", "entity", "attempt"), "later")
    schema = "row bigint, text string, n_entities bigint, kinds string"
    if later.count() <= BROADCAST_ROWS:
        held = spark.sparkContext.broadcast({(r.kind, r.entity): r.attempt for r in later.collect()})
        out = rows.mapInArrow(_replaced(key, lambda: held.value), schema)
        return out.withColumnRenamed("row", "doc_id")
    numbered = common.stage(rows.withColumn("row", F.monotonically_increasing_id()), "pii-rows")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {
                (row, *x)
                for row, t in zip(batch.column(0).to_pylist(), common.texts_of(batch), strict=True)
                for e in find(t)
                for x in parts(e[2], e[3])
            }
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["row", "kind", "entity"],
            )

    own = (
        numbered.select("row", "text")
        .mapInArrow(occurrences, "row bigint, kind string, entity string")
        .join(later, ["kind", "entity"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("later"))
    )
    out = numbered.join(own, "row", "left").select("row", "text", "later").mapInArrow(_replaced(key, dict), schema)
    return out.join(numbered.select("row", "doc_id"), "row").select("doc_id", "text", "n_entities", "kinds")
