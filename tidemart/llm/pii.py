"""Personal data and secrets replaced by keyed surrogates of the same type and format.

Entities are found by patterns and cut into atoms that stand for one thing wherever they occur: an
e-mail's local part and domain, a given name, a surname, a number. Names are runs of capitalised words after a
title or a known given name; a document's bare mentions of the names found in it are replaced, too. An atom's
surrogate is drawn from an HMAC of its kind, value and attempt, so that the same value has the same
surrogate in every document. It keeps length, letter case, separators, country codes, key prefixes and check
digits; given names stay within gender and script.

Distinctness is checked over the whole corpus: where two atoms of a kind would get one surrogate, or a
surrogate is a value that occurs itself, the smallest atom keeps the first attempt and the others try
the next. Later attempts of words are longer, so that their space outgrows the values; what still clashes after
ROUNDS attempts (a format all of whose values occur) gets its kind and 32 digits of its HMAC, so the search
ends. Only atoms beyond their first attempt form a table; documents that hold one get their attempts by
a join, all others need none.

Left in clear: names without a title whose given name is not in the table so most names in
scripts other than the table's, and addresses, dates and numbers of other forms than those in NUMBERS.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import named, others, text_of, written

KEY = "surrogates-1"
ROUNDS = 16             # attempts within the format
LAST = 1 << 20          # the attempt that leaves it
FEW = 1_000_000         # documents with atoms beyond their first attempt that are looked up by broadcast

# Given names by script and gender (fixed values).
GIVEN = {
    ("Latin", "f"): ("Alice Amanda Amy Angela Anna Barbara Betty Carla Carol Clara Deborah Diana Donna Elena Elizabeth Emily Emma Eva Helen Ingrid Irene "
                     "Jane Jennifer Jessica Julia Karen Karin Laura Lena Linda Lisa Lucia Margaret Maria Marta Mary Michelle Nancy Nina Nora Olivia "
                     "Patricia Paula Rosa Ruth Sandra Sarah Sharon Sofia Susan Vera").split(),
    ("Latin", "m"): ("Adam Albert Andrew Anthony Brian Carlos Charles Christopher Daniel David Donald Edward Erik Felix Frank George Hans Henry Hugo Ivan "
                     "James Jason Jeffrey John Jorge Joseph Joshua Karl Kenneth Kevin Lukas Mark Martin Matthew Michael Oscar Paul Peter Richard Robert "
                     "Ronald Ryan Simon Stephen Steven Thomas Timothy William").split(),
    ("Cyrillic", "f"): "Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга София Татьяна Юлия".split(),
    ("Cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Иван Максим Николай Олег Пётр Сергей Юрий".split(),
    ("Greek", "f"): "Άννα Βασιλική Γεωργία Ειρήνη Ελένη Ζωή Μαρία Νίκη Σοφία Χριστίνα".split(),
    ("Greek", "m"): "Ανδρέας Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Μάριος Νίκος Πέτρος Χρήστος".split(),
}
# Titles by the gender they tell; "n" tells none (fixed values).
TITLES = {"m": "Mr Sir Herr Monsieur Señor Sr Господин Κύριος".split(), "f": "Mrs Ms Miss Madam Frau Madame Mme Señora Sra Госпожа Κυρία".split(), "n": "Dr Prof".split()}
SYLLABLES = {"Latin": "ba be bo da den do fa fel ga gor ha hel ka kel la len lo ma mer mo na nor pa per ra ren ro sa sel ta ter to va ven wa wel".split(),
             "Cyrillic": "ба бо ва ве га го да до жа ка ко ла ле ма мо на но па по ра ро са со та то фа ха".split(),
             "Greek": "βα γα δα ζω θα κα κο λα λο μα μο να νο πα πο ρα ρο σα σο τα το φα χα".split()}
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
_GIVEN = {n: sg for sg, ns in GIVEN.items() for n in ns}

_WORD = r"[^\W\d_]"
_UPPER = "[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я]"
_CAPITAL = rf"{_UPPER}(?:['’]{_UPPER})?{_WORD}+(?:['’-]{_UPPER}{_WORD}*)*"
_MORE = 4               # words of a name, at most, after the first
_HEX = "[0-9A-Fa-f]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NUMBERS = re.compile("|".join([
    r"(?P<email>(?<![\w.+-])[\w+-][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z]))",
    rf"(?P<ip>(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d))",
    rf"(?P<mac>(?<![\w:-])(?:{_HEX}{{2}}:){{5}}{_HEX}{{2}}(?![\w:-])|(?<![\w:-])(?:{_HEX}{{2}}-){{5}}{_HEX}{{2}}(?![\w:-]))",
    rf"(?P<ipv6>(?<![\w:])(?:(?:{_HEX}{{1,4}}:){{7}}{_HEX}{{1,4}}|(?:{_HEX}{{1,4}}:){{2,6}}(?::{_HEX}{{1,4}}){{1,5}}|(?:{_HEX}{{1,4}}:)(?::{_HEX}{{1,4}}){{2,6}})(?![\w:]))",
    r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-]))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<card>(?<![\w.-])(?:\d{4}([ -])\d{4}\7\d{4}\7\d{4}|\d{15,16})(?![\w-]))".replace(r"\7", r"(?P=sep)").replace(r"([ -])", r"(?P<sep>[ -])"),
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<secret>(?<!\w)(?:(?:sk|pk|ghp|gho|xoxb|xoxp)[-_][A-Za-z0-9_-]{16,}|AKIA[0-9A-Z]{16}|[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w))",
]))
_FORMS = sorted({f for n in _GIVEN for f in (n, n.upper())}, key=len, reverse=True)
NAMES = re.compile("|".join([
    rf"(?P<titled>(?<!\w)(?P<title>{'|'.join(sorted(_TITLE, key=len, reverse=True))})(?P<gap>\.? )(?P<names>{_CAPITAL}(?: {_CAPITAL}){{0,{_MORE}}})(?!\w))",
    rf"(?P<person>(?<!\w)(?:{'|'.join(_FORMS)})(?: {_CAPITAL}){{1,{_MORE}}}(?!\w))",
]))
# A text without these has no entity; most texts stop here.
_NUMBER_SIGN = re.compile(rf"[\d@]|(?:sk|pk|ghp|gho|xoxb|xoxp)[-_]|AKIA|[0-9a-f]{{32}}|[0-9A-F]{{32}}|{_HEX}[:-]{_HEX}|{_HEX}::{_HEX}")
_NAME_SIGN = re.compile(rf"(?:{'|'.join(sorted([*_TITLE, *_FORMS]))})[. ]")
_KINDS = ("email", "ip", "mac", "ipv6", "phone", "ssn", "card", "iban", "secret", "titled", "person")


def script_of(word: str) -> str:
    c = ord(word[0])
    return "Greek" if 0x370 <= c < 0x400 else "Cyrillic" if 0x400 <= c < 0x530 else "Latin"


Atom = tuple[str, str, str]     # kind, value, text between it and the one before


def _known(word: str) -> str | None:
    """The gender of a given name in the table, written with a capital or in capitals."""
    found = _GIVEN.get(word) or _GIVEN.get(word.title() if word.isupper() else "")
    return found[1] if found else None


def entities(text: str) -> list[tuple[int, int, list[Atom]]]:
    """All entities in order, as (start, end, atoms). Names are looked for between the others, then the bare mentions
    of these names between all."""
    found = [(m.start(), m.end(), _atoms(m)) for m in NUMBERS.finditer(text)] if _NUMBER_SIGN.search(text) else []
    if not _NAME_SIGN.search(text):
        return found
    found = _between(text, found, NAMES, _atoms)
    names = {}
    for _, _, atoms in found:
        for kind, value, _ in atoms:
            if kind == "surname" or kind.startswith("given-"):
                names.setdefault(value, kind)
    if not names:
        return found
    bare = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})(?!\w)")
    return _between(text, found, bare, lambda m: [(names[m.group()], m.group(), "")])


def _between(text: str, found: list, pattern: re.Pattern, atoms) -> list:
    out, at = [], 0
    for entity in [*found, None]:
        out += [(m.start(), m.end(), atoms(m)) for m in pattern.finditer(text, at, entity[0] if entity else len(text))]
        if entity:
            out.append(entity)
            at = entity[1]
    return out


def _atoms(m: re.Match) -> list[Atom]:
    """The atoms of an entity in order."""
    groups = m.groupdict()
    kind = next(k for k in _KINDS if groups.get(k) is not None)
    if kind == "email":
        local, _, domain = m["email"].rpartition("@")
        return [("local", local, ""), ("domain", domain, "@")]
    if kind == "titled":
        gender, names = _TITLE[m["title"]], m["names"].split(" ")
        return _name(names, m["title"] + m["gap"], None if gender == "n" else gender)
    if kind == "person":
        return _name(m["person"].split(" "), "", None)
    return [(kind, m[kind], "")]


def _name(words: list[str], lead: str, gender: str | None) -> list[Atom]:
    """The last word of a name is the surname, the first and all known ones before it are given names."""
    gender = gender or _known(words[0]) or ("f" if words[0][-1] in "aаяα" else "m")
    out = []
    for i, word in enumerate(words):
        given = i < len(words) - 1 and (i == 0 or _known(word))
        out.append((f"given-{gender}" if given else "surname", word, " " if i else lead))
    return out


class _Draws:
    """Numbers from an HMAC stream."""

    def __init__(self, key: str, kind: str, value: str, attempt: int) -> None:
        self.seed = hmac.new(key.encode(), f"{kind}|{value}|{attempt}".encode(), hashlib.sha256).digest()
        self.turn, self.held = 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held = hashlib.sha256(self.seed + self.turn.to_bytes(4, "big")).digest()
            self.turn += 1
        x, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return x % n


def _letters(value: str, d: _Draws, keep: int = 0, hexa: bool = False) -> str:
    """Digits become digits, letters letters of the same case and script; other signs and the first `keep` stay."""
    out = [value[:keep]]
    for c in value[keep:]:
        if c.isdigit():
            out.append(str(d.below(10)))
        elif hexa and c in "abcdefABCDEF":
            out.append(("abcdef" if c.islower() else "ABCDEF")[d.below(6)])
        elif c.isalpha():
            first, n = {"Greek": ("α", 17), "Cyrillic": ("а", 32)}.get(script_of(c), ("a", 26))
            s = chr(ord(first) + d.below(n))
            out.append(s.upper() if c.isupper() else s)
        else:
            out.append(c)
    return "".join(out)


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def _card(value: str, d: _Draws) -> str:
    new = _letters(value, d, 1)
    if luhn(re.sub(r"\D", "", value)) == 0:
        digits = re.sub(r"\D", "", new)
        new = new[:-1] + str((int(digits[-1]) - luhn(digits)) % 10)
    return new


def _iban(value: str, d: _Draws) -> str:
    tail = "".join(_letters(c, d) for c in value[4:])
    plain = re.sub(" ", "", tail) + value[:2] + "00"
    check = 98 - int("".join(str(int(c, 36)) for c in plain)) % 97
    return f"{value[:2]}{check:02d}{tail}"


def _case(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word[:1].upper() + word[1:]


def surrogate(key: str, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of an atom; the same for the same arguments, never the value itself."""
    if attempt >= LAST:
        return f"{kind}-{hmac.new(key.encode(), f'{kind}|{value}'.encode(), hashlib.sha256).hexdigest()[:32]}"
    d = _Draws(key, kind, value, attempt)
    for _ in range(64):
        new = _surrogate(kind, value, d, attempt)
        if new != value:
            return new
    return new + _letters("a", d)


def _surrogate(kind: str, value: str, d: _Draws, attempt: int) -> str:
    if kind == "ip":
        parts = value.split(".")
        keep = 0 if attempt > 1 else 1 if parts[0] in ("10", "127") else 2 if parts[:2] == ["192", "168"] else 0
        return ".".join(parts[:keep] + [str(1 + d.below(223 if not keep and i == 0 else 254)) for i in range(4 - keep)])
    if kind in ("mac", "ipv6"):
        return _letters(value, d, hexa=True)
    if kind == "phone":
        country = re.match(r"\+\d{1,3}", value)
        return _letters(value, d, country.end() if country else 0)
    if kind == "ssn":
        return _letters(value, d)
    if kind == "card":
        return _card(value, d)
    if kind == "iban":
        return _iban(value, d)
    if kind == "secret":
        lead = re.match(r"(?:sk|pk|ghp|gho|xoxb|xoxp)[-_]|AKIA", value)
        return _letters(value, d, lead.end() if lead else 0, hexa=not lead)
    if kind == "domain":
        name, dot, top = value.rpartition(".")
        return _letters(_longer(name, attempt), d) + dot + top
    if kind.startswith("given-"):
        script = script_of(value)
        names = GIVEN[script, kind[-1]]
        more = "".join(SYLLABLES[script][d.below(len(SYLLABLES[script]))] for _ in range(max(0, attempt - 2)))
        return _case(names[d.below(len(names))] + more, value)
    if kind == "surname":
        return "".join(part if part in "'’-" else _surname(part, d, attempt) for part in re.split("(['’-])", value) if part)
    return _letters(_longer(value, attempt), d)


def _longer(value: str, attempt: int) -> str:
    """Short words grow with the first clash, others with the second."""
    return value + "a" * (attempt if len(value) <= 3 else max(0, attempt - 1))


def _surname(value: str, d: _Draws, attempt: int) -> str:
    if len(value) == 1:
        return _letters(value, d)
    syllables = SYLLABLES[script_of(value)]
    return _case("".join(syllables[d.below(len(syllables))] for _ in range(3 + d.below(2) + attempt)), value)


def replace(text: str, key: str, attempts: dict[str, int]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds of what was replaced, in order."""
    out, kinds, at = [], [], 0
    for start, end, found in entities(text):
        kinds.append(found[0][0] if found[0][0] != "local" else "email")
        out.append(text[at:start])
        out += [lead + surrogate(key, kind, value, attempts.get(f"{kind}|{value}", 0)) for kind, value, lead in found]
        at = end
    return "".join(out) + text[at:], kinds


def _distinct_attempts(atoms: DataFrame, key: str) -> DataFrame:
    """(atom, attempt) of the atoms whose first surrogate another atom has, or is a value that occurs."""
    def draw(kind: str, value: str, attempt: int) -> str:
        return surrogate(key, kind, value, attempt)

    @F.arrow_udf("string")
    def drawn(kind: pa.Array, value: pa.Array, attempt: pa.Array) -> pa.Array:
        return pa.array([draw(*x) for x in zip(kind.to_pylist(), value.to_pylist(), attempt.to_pylist(), strict=True)], pa.string())

    now = written(atoms.withColumn("attempt", F.lit(0)).withColumn("new", drawn("kind", "value", "attempt")), "pii-atoms")
    real = now.select("kind", F.col("value").alias("new"), F.lit(True).alias("real"))
    for turn in range(ROUNDS + 1):
        first = now.groupBy("kind", "new").agg(F.min(F.struct("attempt", "value")).alias("first"))
        clash = (now.join(first, ["kind", "new"]).join(real, ["kind", "new"], "left")
                 .withColumn("again", F.coalesce("real", F.lit(False)) | (F.struct("attempt", "value") != F.col("first"))))
        if clash.where("again").isEmpty():
            break
        following = F.lit(LAST) if turn == ROUNDS else F.col("attempt") + 1
        now = written(clash.select("kind", "value", F.when(F.col("again"), following).otherwise(F.col("attempt")).alias("attempt"), "again", "new")
                      .withColumn("new", F.when(F.col("again"), drawn("kind", "value", "attempt")).otherwise(F.col("new"))).drop("again"), "pii-atoms")
    return now.where("attempt > 0").select(F.concat_ws("|", "kind", "value").alias("atom"), "attempt")


RESULTS = ["text", "n_entities", "kinds"]


def with_surrogates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """All rows of `df` with the text replaced, and n_entities and kinds (in order) added.

    Null text stays null with no entities. Texts without entities stay as they are, however long. The
    other columns stay; those named like a result are replaced. An empty table gives an empty one.
    """
    docs = df.select(F.xxhash64(named(id_col), text_of(named(text_col))).alias("_row"), named(text_col).cast("string").alias("text"))

    def find_atoms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, values = [], [], []
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind, value in {(k, v) for _, _, found in entities(text or "") for k, v, _ in found}:
                    rows.append(row)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["_row", "kind", "value"])

    held = written(docs.mapInArrow(find_atoms, "_row long, kind string, value string"), "pii-held")
    later = _distinct_attempts(held.select("kind", "value").distinct(), key)
    affected = written(held.withColumn("atom", F.concat_ws("|", "kind", "value")).join(later, "atom")
                       .groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("atom", "attempt"))).alias("_attempts")), "pii-attempts")
    few = affected.count() <= FEW

    @F.arrow_udf("struct<text:string,kinds:array<string>>")
    def swapped(text: pa.Array, atoms: pa.Array, attempts: pa.Array) -> pa.Array:
        new, kinds = [], []
        for t, a, n in zip(text.to_pylist(), atoms.to_pylist(), attempts.to_pylist(), strict=True):
            x, k = (None, []) if t is None else replace(t, key, dict(zip(a or [], n or [], strict=True)))
            new.append(x)
            kinds.append(k)
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(kinds, pa.list_(pa.string()))], ["text", "kinds"])

    rows = df.select(F.struct(*others(df, set(RESULTS))).alias("_in"), F.xxhash64(named(id_col), text_of(named(text_col))).alias("_row"),
                     named(text_col).cast("string").alias("_text"))
    new = (rows.join(F.broadcast(affected) if few else affected, "_row", "left")
           .select("_in", swapped("_text", F.map_keys("_attempts"), F.map_values("_attempts")).alias("_new")))
    return new.select("_in.*", F.col("_new.text").alias("text"), F.col("_new.kinds").alias("kinds"), F.size("_new.kinds").alias("n_entities"))
