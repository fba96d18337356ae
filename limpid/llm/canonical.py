"""Problem 5: mapping free-entered values to a canonical list."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No entry of the list fits: unknown, placeholder, or several entries at once.
NO_ENTRY = -1
# Words that say nothing about which solvent it is (grades, handling, where it was noted).
QUALIFIERS = frozenset(
    "abs absolute anhydrous analytical bidest bidistilled chromatography demineralised demineralized deionised deionized di dist distilled "
    "double dried dry extra filtered fresh freshly from grade gradient high hplc in lc lcms milli milliq ms molecular neat no note over p p.a pa page "
    "per percent pharma pure purified purissimum puriss purity quality reagent recheck redistilled see sieve sieved sieves solution solvent spectroscopic "
    "stabilised stabilized sterile super technical the ultra ultrapure used uv grad lot batch bottle medium".split()
)
# Entries that only say that nothing was recorded.
PLACEHOLDERS = frozenset("unknown|n/a|na|nan|none|null|not recorded|not given|not stated|not known|not specified|unspecified|see comment|see comments|see note|see notes|missing|tbd|other|various|solvent|mixture".split("|"))
#: Typing errors that an alias may carry: at most so many for each letter of the alias (rounded down, one at least).
ERROR_RATE = 0.25
_TOKEN = re.compile(r"[^\W_]+(?:\.[^\W\d_])*")
_MIXED = re.compile(r"\d\s*:\s*\d|\s\+\s|/|\bmixture\b|\bmix\b|\band\b|\bwith\b|&")


def _plain(text: str) -> str:
    """Compatibility forms folded, lower case, single blanks."""
    return " ".join(unicodedata.normalize("NFKC", text).lower().split())


def _solid(text: str) -> str:
    """Only the letters and digits."""
    return "".join(c for c in text if c.isalnum())


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between a and b; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def token_distance(a: tuple[str, ...], b: tuple[str, ...], most: int) -> int:
    """Edits that make the token set a from b, whatever the order: matched tokens cost their edits, tokens without a
    partner their letters; most + 1 if it is more. The assignment is the best of all."""
    if len(a) < len(b):
        a, b = b, a
    best = {0: 0}  # cost by the set of tokens of a that are taken
    for y in b:
        more: dict[int, int] = {}
        for taken, cost in best.items():
            options = [(taken, len(y))] + [(taken | 1 << i, edit_distance(x, y, most)) for i, x in enumerate(a) if not taken >> i & 1]
            for mask, d in options:
                if cost + d <= most and cost + d < more.get(mask, most + 1):
                    more[mask] = cost + d
        best = more
    return min((cost + sum(len(x) for i, x in enumerate(a) if not taken >> i & 1) for taken, cost in best.items()), default=most + 1)


class Matcher:
    """Maps one value at a time; built from the rows (id, canonical name, abbreviation, synonyms, structure) of the list."""

    def __init__(self, rows: list[tuple[int, str | None, str | None, str | None, str | None]]):
        self.rows = rows
        self.exact: dict[str, int] = {}
        self.structure: dict[str, int] = {}
        self.aliases: dict[str, int] = {}
        self.sets: dict[str, tuple[tuple[str, ...], Counter]] = {}
        auto = ahocorasick.Automaton()
        for sid, name, short, synonyms, smiles in sorted(rows, key=lambda r: r[0]):
            long = [x for x in (name, *(synonyms or "").split("|")) if x and x.strip()]
            for alias in [*long, *([short] if short else [])]:
                plain = _plain(alias)
                if not _solid(plain):
                    continue
                self.exact.setdefault(_solid(plain), sid)
                auto.add_word(plain, (len(plain), self.exact[_solid(plain)]))
                if alias in long:
                    self.aliases.setdefault(_solid(plain), sid)
                    self.sets.setdefault(_solid(plain), (tuple(_TOKEN.findall(plain)), Counter(_solid(plain))))
            if smiles and smiles.strip():
                self.structure.setdefault(smiles.strip(), sid)
        auto.make_automaton()
        self.auto, self.empty = auto, not self.exact
        self.known: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"rows": self.rows}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["rows"])

    def match(self, value: str) -> int:
        got = self.known.get(value)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[value] = self._match(value)
        return got

    def _match(self, value: str) -> int:
        bare = value.strip()
        plain = _plain(value)
        solid = _solid(plain)
        if not solid or plain in PLACEHOLDERS or self.empty:
            return NO_ENTRY
        if bare in self.structure:
            return self.structure[bare]
        if solid in self.exact:
            return self.exact[solid]
        spans = self._mentions(plain)
        ids = {sid for _, _, sid in spans}
        if len(ids) > 1:
            return NO_ENTRY
        rest = plain
        for a, b, _ in reversed(spans):
            rest = f"{rest[:a]} \0 {rest[b:]}"
        if ids and self._idle(rest):
            return next(iter(ids))
        return NO_ENTRY if _MIXED.search(plain) else self._similar(plain)

    def _mentions(self, plain: str) -> list[tuple[int, int, int]]:
        """Aliases that stand in the text as whole words: the longest first, none overlapping another."""
        found = []
        for end, (size, sid) in self.auto.iter(plain):
            a, b = end - size + 1, end + 1
            if (a == 0 or not plain[a - 1].isalnum()) and (b == len(plain) or not plain[b].isalnum()):
                found.append((a, b, sid))
        taken: list[tuple[int, int, int]] = []
        for a, b, sid in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
            if all(b <= c or a >= d for c, d, _ in taken):
                taken.append((a, b, sid))
        return sorted(taken)

    def _idle(self, rest: str) -> bool:
        """Whether only qualifiers, numbers and short marks are left."""
        for w in _TOKEN.findall(rest.replace("\0", " ")):
            if w in QUALIFIERS or re.fullmatch(r"[\d.]+[a-z]?", w) or len(w) == 1:
                continue
            if any(len(q) >= 5 and edit_distance(w, q, 1) <= 1 for q in QUALIFIERS):
                continue
            return False
        return True

    def _similar(self, plain: str) -> int:
        """Token-set similarity: qualifiers aside, the alias with the fewest errors for its length.

        Errors are the edits between the token sets, in any order, also with two neighbouring tokens as one, or between
        the letters as a whole where tokens were parted or run together, whichever are fewer.
        """
        tokens = _TOKEN.findall(plain)
        core = [w for w in tokens if w not in QUALIFIERS]
        best: list[tuple[float, int]] = []
        for words in dict.fromkeys((tuple(tokens), tuple(core), tuple(core[:-1]) if len(core) > 1 and core[-1].isdigit() else ())):
            text = "".join(words)
            if not text:
                continue
            letters = Counter(text)
            for alias, sid in self.aliases.items():
                most = max(1, int(len(alias) * ERROR_RATE))
                parts, held = self.sets[alias]
                # no way of counting has fewer errors than the letters that only one side holds
                if abs(len(text) - len(alias)) > most or (letters - held).total() > most or (held - letters).total() > most:
                    continue
                d = edit_distance(text, alias, most)
                if d and (len(words) > 1 or len(parts) > 1):
                    ways = [words, *(words[:i] + (words[i] + words[i + 1],) + words[i + 2 :] for i in range(len(words) - 1))]
                    d = min(d, *(token_distance(w, parts, most) for w in ways))
                if d <= most and (len(alias) > 3 or d == 0):
                    best.append((d / len(alias), sid))
        if not best:
            return NO_ENTRY
        low = min(best)[0]
        ids = {sid for r, sid in best if r <= low + 1e-9}
        return next(iter(ids)) if len(ids) == 1 else NO_ENTRY


def map_values(records: DataFrame, reference: DataFrame, column: str = "solvent", key: str = "rec_id") -> DataFrame:
    """(rec_id, solvent_id) for every row whose value is neither null, blank nor exactly a canonical name.

    An automaton over all names, synonyms and abbreviations finds embedded mentions; the longest non-overlapping ones
    win. Mentions of two entries and placeholders give -1. Other values, also those with words beside the mention that
    are no mere qualifiers, go to the alias whose token set is the nearest, in any order and with typing errors, -1 if
    there are too many errors or two entries are as near. Structures only count as the whole value. The reference list is small by its nature and
    checked to be (10,000 rows); rows are mapped where they lie, without a shuffle, and every worker remembers the
    values it has met. Very long values are read whole. Repeated rows are mapped alike; extra columns are ignored.
    """
    ref = [tuple(r) for r in reference.select(F.col("solvent_id").cast("long"), "canonical_name", "abbreviation", "synonyms", "smiles_solvent").where("solvent_id IS NOT NULL").limit(10_001).collect()]
    if len(ref) > 10_000:
        raise ValueError("the reference list has more than 10,000 rows")
    names = sorted({r[1] for r in ref if r[1]})
    matcher = Matcher(ref)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, values = pd.factorize(pdf["v"])
            ids = pd.array([matcher.match(v) for v in values], dtype="int64")
            yield pd.DataFrame({key: pdf["k"], "solvent_id": ids.take(codes)})

    todo = records.select(F.col(key).alias("k"), F.col(column).alias("v")).where(F.col("v").rlike(r"\S"))
    todo = todo.where(~F.col("v").isin(names)) if names else todo
    return todo.mapInPandas(run, f"{key} {records.schema[key].dataType.simpleString()}, solvent_id long")


def unmatched_values(records: DataFrame, mapped: DataFrame, column: str = "solvent", key: str = "rec_id") -> DataFrame:
    """(solvent, rows): every value that fits no entry, with how many rows hold it."""
    lost = mapped.where(F.col("solvent_id") == NO_ENTRY).select(key)
    return records.join(lost, key, "left_semi").groupBy(column).agg(F.count("*").alias("rows"))
