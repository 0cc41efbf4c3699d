"""PII: detected entities get keyed surrogates of their own type and format.

An entity is its kind and canonical value (digits alone, or lower case), so every mention of it anywhere gets the same
surrogate: numbers are written into the mention's own punctuation, names and addresses follow its case. A surrogate
is drawn from a keyed hash of the entity and an attempt number, of the same length, script, gender and validity
(card check digit, IBAN check digits, address ranges); the domain of an address ends in the reserved ``example``.
Distinct entities are compared over the whole corpus: an attempt that hits a detected original, or a surrogate
someone else has, is drawn again, until none is left. Where a form runs out of values, later attempts are longer.

Persons and mail addresses are replaced part by part: each given name, family name, local part and domain is an entity of
its own, whatever the form of address. So ``Mr John Smith`` and a later ``Mr Smith`` keep one family name, ``Dr Anna Bell``
and ``Ms Anna Bell`` are one person, addresses of one domain still share one, and as no two parts get one surrogate, no
two names or addresses do. A given name gets the gender that its mentions tell, if they agree. Initials are moved along
the alphabet by a keyed distance.

Names are found after a form of address: up to three capitalised words, particles (``von``), apostrophes, hyphens and
initials included. Telephone numbers need a plus sign, brackets or parted groups: ten digits in a row may be anything.

Only texts that may hold an entity are shuffled, once, in blocks; the rest pass untouched. Null texts stay null,
empty ones empty. Rows may repeat. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.blocks import block_number, release
from placemat.llm.core import shuffle_partitions
from placemat.scratch import stage

#: For tests and examples. Pass a secret of your own where the originals must not be guessed.
EXAMPLE_KEY = "placemat example key"

# Forms of address, by the gender they tell.
MALE = "Mr|Herr|Monsieur|Señor|Sr|г-н|κ"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|г-жа|κα"
EITHER = "Dr|Prof"

_WORD = r"[^\W\d_]"
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"[\w.%+-]*[\w%+-]@(?:[\w-]+\.)+[^\W\d_]{2,}"),
    ("iban", r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("ipv6", r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![\w:]|\.[0-9])"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\w|\.[0-9])"),
    ("card", r"(?<!\w)[0-9](?:[ -]?[0-9]){12,18}(?!\w)"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("phone", r"(?<![\w+(])(?:\+[0-9]{9,14}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){0,1}[ .-][0-9]{6,10}|\+[0-9]{1,3}(?:[ .-][0-9]{1,4}){3,5}|(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4})(?!\w)"),
)
# Small words inside family names.
PARTICLES = "von|van|der|den|ter|zu|zur|de|del|della|di|da|dos|la|le|du|al|el|bin"
TITLE = re.compile(rf"(?<!\w)({MALE}|{FEMALE}|{EITHER})\.? ")
TITLES = frozenset("|".join((MALE, FEMALE, EITHER)).split("|"))
NAME_WORD = re.compile(
    rf"(?P<particles>(?:(?:{PARTICLES}) )*)(?:(?P<initial>{_WORD})\.|(?P<word>{_WORD}+(?:['’-]{_WORD}+)*))"
)
#: True of every text with an entity, for the scan; digits may be parted by what the patterns allow.
MAYBE = (
    rf"@|\d(?:[ .()-]{{0,2}}\d){{3}}|[A-Z]{{2}}\d\d ?[A-Z0-9]{{4}}|:[0-9A-Fa-f]{{0,4}}:"
    rf"|(?=[MHSFDPгκ])(?:{MALE}|{FEMALE}|{EITHER})\.? (?:(?:{PARTICLES}) )*\p{{IsUppercase}}"
)
DIGITS = ("ip", "card", "ssn", "phone")

# Names by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karim Louis Marco Noah Oscar Paul".split(),
    ("latin", "f"): "Anna Berta Clara Dora Elena Flora Greta Hanna Irene Julia Karla Laura Maria Nora Olga Paula".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Игорь Кирилл Лев Максим Никита Олег Павел Роман".split(),
    ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Инна Клара Лидия Мария Нина Ольга Полина Раиса".split(),
    ("greek", "m"): "Άγγελος Βασίλης Γιάννης Δημήτρης Ηλίας Κώστας Λευτέρης Μάνος Νίκος Πέτρος".split(),
    ("greek", "f"): "Άννα Βάσω Γεωργία Δέσποινα Ελένη Κατερίνα Λένα Μαρία Νίκη Σοφία".split(),
}
FAMILY = {
    "latin": "Abel Berg Costa Duran Ekman Fabre Garza Holm Ibsen Jansen Keller Lopez Moreau Novak Olsen Perez Quint Rossi".split(),
    "cyrillic": "Бондаренко Гончар Дорош Коваленко Лысенко Мороз Панченко Руденко Савченко Ткаченко Шевченко".split(),
    "greek": "Αλεξίου Βλάχου Γεωργίου Δήμου Ιωάννου Κώστα Λάμπρου Νικολάου Παππά Σταύρου".split(),
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}


def script_of(letter: str) -> str:
    if "Ͱ" <= letter <= "Ͽ":
        return "greek"
    return "cyrillic" if "Ѐ" <= letter <= "ӿ" else "latin"


def name_words(text: str, at: int) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` of the words of a name that begins at a place, none if there is none.

    The last word is the family name with its particles, those before it are given names or initials.
    """
    words: list[tuple[int, int, str, str]] = []
    while sum(kind != "initial" for _, _, kind, _ in words) < 3 and (m := NAME_WORD.match(text, at)):
        word = m["initial"] or m["word"]
        if word in TITLES or not word[0].isupper():
            break
        # A compound such as "Smith-led" ends where its small letters begin.
        end = m.end() if m["initial"] else m.start("word") + len(re.split(r"-(?=[^\W\d_])", word)[0])
        for piece in re.finditer(r"-([^\W\d_])[^-]*", word) if not m["initial"] else ():
            if not piece[1].isupper():
                break
            end = m.start("word") + piece.end()
        words.append((m.start(), end, "initial" if m["initial"] else "given", text[m.start() : end].lower()))
        at = end + text.startswith(" ", end)
        if at == end and not m["initial"]:
            break
    # A single letter with a full stop is a name only before another word.
    while words and words[-1][2] == "initial" and len(words) > 1:
        words.pop()
    if words and words[-1][2] == "given":
        words[-1] = (*words[-1][:2], "family", words[-1][3])
    return words


def persons(text: str) -> Iterator[tuple[int, int, str]]:
    """``start, end, canonical`` of names after a form of address; the search goes on behind each name."""
    at = 0
    while m := TITLE.search(text, at):
        words = name_words(text, m.end())
        at = words[-1][1] if words else m.end()
        if words:
            gender = "m" if m[1] in MALE.split("|") else "f" if m[1] in FEMALE.split("|") else "x"
            yield words[0][0], at, f"{gender}:{text[words[0][0] : at].lower()}"


def parts(kind: str, mention: str) -> list[tuple[str, str]]:
    """``kind, canonical`` of what has a surrogate of its own in a mention of an entity."""
    if kind == "person":
        return [(part, canonical) for _, _, part, canonical in name_words(mention, 0) if part != "initial"]
    if kind == "email":
        local, _, domain = mention.lower().partition("@")
        return [("local", local), ("domain", domain)]
    return []


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` without overlaps: the earliest first, then the order of PATTERNS."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        if kind == "email" and "@" not in text:
            continue
        for m in re.finditer(pattern, text):
            if kind == "ipv6":
                try:
                    canonical = f"{ipaddress.IPv6Address(m[0]).exploded}"
                except ValueError:
                    continue
                found.append((m.start(), rank, m.end(), kind, canonical))
            elif kind == "ip":
                found.append((m.start(), rank, m.end(), kind, ".".join(str(int(x)) for x in m[0].split("."))))
            elif kind in DIGITS:
                found.append((m.start(), rank, m.end(), kind, re.sub(r"\D", "", m[0])))
            else:
                found.append((m.start(), rank, m.end(), kind, m[0].lower().replace(" ", "")))
    found += [(start, len(PATTERNS), end, "person", canonical) for start, end, canonical in persons(text)]
    out, upto = [], 0
    for start, _, end, kind, canonical in sorted(found):
        if start >= upto and end > start:
            out.append((start, end, kind, canonical))
            upto = end
    return out


def _draws(key: str, kind: str, canonical: str, attempt: int) -> Callable[[int], int]:
    """Numbers below a bound, one after another, from the keyed hash."""
    block, held = 0, bytearray()

    def draw(bound: int) -> int:
        nonlocal block, held
        if len(held) < 8:
            message = f"{kind}\0{canonical}\0{attempt}\0{block}".encode()
            held += hmac.new(key.encode(), message, hashlib.sha256).digest()
            block += 1
        value = int.from_bytes(held[:8], "little")
        del held[:8]
        return value % bound

    return draw


def luhn(digits: str) -> int:
    """0 where the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _shaped(text: str, draw: Callable[[int], int]) -> str:
    """Letters for letters of the same script, digits for digits, the rest as it is."""
    out = []
    for c in text:
        if c.isdecimal():
            out.append(str(draw(10)))
        elif c.isalpha():
            letters = ALPHABETS[script_of(c)]
            out.append(letters[draw(len(letters))])
        else:
            out.append(c)
    return "".join(out)


def _iban(canonical: str, draw: Callable[[int], int]) -> str:
    body = _shaped(canonical[4:], draw)
    number = "".join(str(int(c, 36)) for c in body + canonical[:2])
    return f"{canonical[:2]}{98 - int(number + '00') % 97:02d}{body}"


def surrogate(key: str, kind: str, canonical: str, attempt: int, gender: str = "x") -> str:
    """The canonical value of the surrogate; ``gender`` is that of a given name."""
    draw = _draws(key, kind, canonical, attempt)
    if kind == "local":
        return _shaped(canonical + next((c for c in canonical if c.isalpha()), "a") * (attempt // 4), draw)
    if kind == "domain":
        labels = canonical.split(".")[:-1]
        labels[0] += next((c for c in labels[0] if c.isalpha()), "a") * (attempt // 4)
        return ".".join([*(_shaped(x, draw) for x in labels), "example"])
    if kind in ("given", "family"):
        script = script_of(canonical.rpartition(" ")[2][0])
        names = [n for g in ("m", "f") if gender in (g, "x") for n in GIVEN[script, g]] if kind == "given" else FAMILY[script]
        # Names run out sooner than numbers: later attempts are compounds.
        return "-".join(names[draw(len(names))] for _ in range(1 + attempt // 2)).lower()
    if kind == "ipv6":
        # The range for documentation.
        return ":".join(["2001", "0db8", *(f"{draw(65536):04x}" for _ in range(6))])
    if kind == "ip":
        first = canonical.split(".")[0]
        keep = first in ("10", "127") and attempt < 8
        return ".".join([first if keep else str(1 + draw(223)), *[str(draw(256)) for _ in range(3)]])
    # Numbers run out where a corpus has about half of all of their form: then digits are added at the end.
    valid = kind == "card" and luhn(canonical) == 0
    canonical += "0" * (attempt // 8)
    if kind == "iban":
        return _iban(canonical, draw)
    if kind == "card":
        body = canonical[0] + "".join(str(draw(10)) for _ in canonical[2:])
        check = next(d for d in "0123456789" if luhn(body + d) == 0)
        wrong = str((int(check) + 1 + draw(9)) % 10)
        return body + (check if valid else wrong)
    if kind == "phone":
        return canonical[:1] + "".join(str(draw(10)) for _ in canonical[1:])
    return "".join(str(draw(10)) for _ in canonical)


def moved_initial(key: str, letter: str) -> str:
    """Another letter of the alphabet, a different one for each; a letter of no alphabet here becomes one that is."""
    letters = ALPHABETS[script_of(letter)]
    by = 1 + _draws(key, "initial", letters, 0)(len(letters) - 1)
    at = letters.find(letter.lower())
    return letters[(at + by) % len(letters)].upper()


def _cased(mention: str, value: str) -> str:
    letters = [c for c in mention if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return value.upper()
    return value


def rendered(kind: str, mention: str, value: str) -> str:
    """The surrogate in the punctuation and case of the mention."""
    if kind in DIGITS and kind != "ip":
        digits = iter(value)
        return "".join([*(next(digits) if c.isdecimal() else c for c in mention), *digits])
    if kind == "ip":
        return value
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(value)) if "::" in mention else value
    if kind == "iban":
        letters = iter(value.upper())
        return "".join([*(c if c == " " else next(letters) for c in mention), *letters])
    if kind in ("given", "family"):
        return _cased(mention, value.title())
    letters = [c for c in mention if c.isalpha()]
    cased = _cased(mention, value)
    return cased[:1].upper() + cased[1:] if kind == "local" and letters and letters[0].isupper() else cased


def replaced(key: str, kind: str, canonical: str, mention: str, table: dict[tuple[str, str], str]) -> str:
    """What a mention becomes: its surrogate, or those of its parts."""
    if kind == "person":
        out, at = [], 0
        for start, end, part, name in name_words(mention, 0):
            new = moved_initial(key, mention[start]) + "." if part == "initial" else rendered(part, mention[start:end], table[part, name])
            out += [mention[at:start], new]
            at = end
        return "".join(out)
    if kind == "email":
        local, _, domain = mention.partition("@")
        shouted = local.isupper() and domain.isupper()
        new = table["domain", domain.lower()]
        return f"{rendered('local', local, table['local', local.lower()])}@{new.upper() if shouted else new}"
    return rendered(kind, mention, table[kind, canonical])


def replace(text: str, table: dict[tuple[str, str], str], key: str = EXAMPLE_KEY) -> tuple[str, int]:
    """Text with every entity replaced by its surrogate, and their number."""
    out, at, n = [], 0, 0
    for start, end, kind, canonical in entities(text):
        out += [text[at:start], replaced(key, kind, canonical, text[start:end], table)]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def keyed_parts(text: str) -> Iterator[tuple[str, str, str]]:
    """``kind, canonical, gender`` of all that needs a surrogate of its own."""
    for start, end, kind, canonical in entities(text):
        gender = canonical[0] if kind == "person" else "x"
        for part, value in parts(kind, text[start:end]) if kind in ("person", "email") else [(kind, canonical)]:
            yield part, value, gender if part == "given" else "x"


def _found_in_blocks(blocked: DataFrame) -> DataFrame:
    """``block, kind, canonical, gender``, each once per task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for block, text in zip(batch.column("block"), batch.column("text"), strict=True):
                own = block.as_py()
                seen.update((own, *part) for part in keyed_parts(text.as_py() or ""))
            columns = list(zip(*sorted(seen), strict=True)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "kind", "canonical", "gender"]
            )

    out = "block int, kind string, canonical string, gender string"
    return blocked.select("block", "text").mapInArrow(read, out).distinct()


def distinct_parts(pairs: DataFrame) -> DataFrame:
    """``kind, canonical, gender``: a name's gender is what its mentions tell, ``x`` if nothing or both."""
    told = F.collect_set(F.when(F.col("gender") != "x", F.col("gender")))  # two values at most
    gender = F.when(F.size(told) == 1, told[0]).otherwise("x")
    return pairs.groupBy("kind", "canonical").agg(gender.alias("gender"))


def assign_surrogates(found: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct parts (``kind, canonical, gender``), no two alike, none an original.

    Each round draws for all that are left, keeps the first claimant of every free surrogate, and is written once.
    """
    proposals = "kind string, canonical string, surrogate string"

    def draw(attempt: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = zip(*[b.column(c).to_pylist() for c in ("kind", "canonical", "gender")], strict=True)
                drawn = [surrogate(key, kind, canonical, attempt, gender) for kind, canonical, gender in rows]
                yield pa.RecordBatch.from_arrays(
                    [b.column("kind"), b.column("canonical"), pa.array(drawn, pa.string())],
                    ["kind", "canonical", "surrogate"],
                )

        return propose

    left, accepted, attempt = found.select("kind", "canonical", "gender"), None, 0
    originals = found.select("kind", F.col("canonical").alias("surrogate"))
    while True:
        drawn = left.mapInArrow(draw(attempt), proposals)
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        taken = originals if accepted is None else originals.unionByName(accepted.select("kind", "surrogate"))
        free = stage(first.join(taken, ["kind", "surrogate"], "left_anti"), "surrogates")
        accepted = free if accepted is None else accepted.unionByName(free)
        left = stage(left.join(free, ["kind", "canonical"], "left_anti"), "unassigned")
        if left.isEmpty():
            return accepted.select("kind", "canonical", "surrogate")
        attempt += 1


def replace_entities(
    docs: DataFrame, key: str = EXAMPLE_KEY, row_key: str = "doc_id", text: str = "text", count: str | None = "n_replaced"
) -> DataFrame:
    """``docs`` with entities in ``text`` replaced and, unless ``count`` is None, their number in that column."""
    columns = [c for c in docs.columns if c != count]
    docs = docs.select(*columns)
    maybe = F.coalesce(F.col(text).rlike(MAYBE), F.lit(False))
    parts = shuffle_partitions(docs.sparkSession)
    row = F.struct(*[c for c in columns if c != text]).alias("row")
    blocked = docs.filter(maybe).select(
        row, F.col(text).alias("text"), block_number(docs, F.struct(row_key, text)).alias("block")
    ).repartition(parts, "block")
    pairs = stage(_found_in_blocks(blocked), "mentions")
    found = stage(distinct_parts(pairs), "entities")
    known = pairs.select("block", "kind", "canonical").join(assign_surrogates(found, key), ["kind", "canonical"])

    def write(own: pa.Table, entries: pa.Table) -> pa.Table:
        release()
        names = zip(entries.column("kind").to_pylist(), entries.column("canonical").to_pylist(), strict=True)
        table = dict(zip(names, entries.column("surrogate").to_pylist(), strict=True))
        out = [replace(t.as_py(), table, key) for t in own.column("text")]
        return pa.table(
            {
                "row": own.column("row"),
                "text": pa.array([t for t, _ in out], pa.string()),
                "n": pa.array([n for _, n in out], pa.int64()),
            }
        )

    kind = blocked.schema["row"].dataType.simpleString()
    touched = blocked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        write, f"row {kind}, text string, n long"
    )

    def back(c: str) -> Column:
        return F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c)

    changed = touched.select(*[back(c) for c in columns], *([F.col("n").alias(count)] if count else []))
    untouched = docs.filter(~maybe).select(*columns, *([F.lit(0).cast("long").alias(count)] if count else []))
    return untouched.unionByName(changed)
