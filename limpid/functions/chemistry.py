"""Molecules from SMILES: validity, composition, simple descriptors and circular fingerprints.

An own kernel for the organic part of the notation, run on distinct structures in Arrow batches. Tautomers, canonical
spellings, InChIKeys, 3-D conformers and large descriptor sets need a chemistry library and are taken as inputs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Standard atomic weights, atomic numbers and usual valences.
WEIGHT = {"H": 1.008, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "Na": 22.990, "Mg": 24.305, "Si": 28.085, "P": 30.974, "S": 32.06, "Cl": 35.45, "K": 39.098, "Ca": 40.078, "Zn": 65.38, "Se": 78.971, "Br": 79.904, "I": 126.904, "Li": 6.94}
NUMBER = {"H": 1, "Li": 3, "B": 5, "C": 6, "N": 7, "O": 8, "F": 9, "Na": 11, "Mg": 12, "Si": 14, "P": 15, "S": 16, "Cl": 17, "K": 19, "Ca": 20, "Zn": 30, "Se": 34, "Br": 35, "I": 53}
VALENCES = {"B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5), "S": (2, 4, 6), "F": (1,), "Cl": (1,), "Br": (1,), "I": (1,)}
# Polar surface contributions by (element, aromatic, hydrogens, charge, highest bond order, neighbours).
POLAR = {
    ("N", 0, 0, 0, 1, 3): 3.24, ("N", 0, 1, 0, 1, 2): 12.03, ("N", 0, 2, 0, 1, 1): 26.02, ("N", 0, 0, 0, 2, 2): 12.36, ("N", 0, 1, 0, 2, 1): 23.85, ("N", 0, 0, 0, 3, 1): 23.79,
    ("N", 0, 0, 1, 2, 3): 3.01, ("N", 0, 1, 1, 1, 3): 4.44, ("N", 0, 2, 1, 1, 2): 16.61, ("N", 0, 3, 1, 1, 1): 27.64, ("N", 1, 0, 0, 1, 2): 12.89, ("N", 1, 0, 0, 1, 3): 4.93, ("N", 1, 1, 0, 1, 2): 15.79,
    ("O", 0, 0, 0, 1, 2): 9.23, ("O", 0, 1, 0, 1, 1): 20.23, ("O", 0, 0, 0, 2, 1): 17.07, ("O", 0, 0, -1, 1, 1): 23.06, ("O", 1, 0, 0, 1, 2): 13.14,
}
BITS, RADIUS = 2048, 2
_TOKEN = re.compile(r"\[[^\[\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|[-=#:/\\()+.]|%\d\d|\d")
_ATOM = re.compile(r"^\[(\d+)?([A-Z][a-z]?|[bcnops]|se)(@{0,2})(?:H(\d*))?((?:\+\d*|-\d*|\++|-+)?)(?::\d+)?\]$")
_ORDER = {"-": 1, "/": 1, "\\": 1, "=": 2, "#": 3, ":": 4}


@dataclass
class Molecule:
    symbol: list[str] = field(default_factory=list)
    aromatic: list[bool] = field(default_factory=list)
    charge: list[int] = field(default_factory=list)
    hydrogens: list[int] = field(default_factory=list)
    bonds: list[tuple[int, int, int]] = field(default_factory=list)  # order 4 is aromatic

    def neighbours(self) -> list[list[tuple[int, int]]]:
        out: list[list[tuple[int, int]]] = [[] for _ in self.symbol]
        for a, b, o in self.bonds:
            out[a].append((b, o))
            out[b].append((a, o))
        return out


def parse(smiles: str | None) -> Molecule | None:
    """The molecule, or None for null, '', 'nan', several fragments, syntax errors and impossible valences."""
    if not smiles or smiles != smiles.strip() or smiles.lower() == "nan" or "." in smiles:
        return None
    mol, stack, last, order, rings = Molecule(), [], -1, 0, {}
    fixed: list[bool] = []
    at = 0
    while at < len(smiles):
        m = _TOKEN.match(smiles, at)
        if not m:
            return None
        at, t = m.end(), m[0]
        if t == "(":
            if last < 0:
                return None
            stack.append(last)
        elif t == ")":
            if not stack or order:
                return None
            last = stack.pop()
        elif t in _ORDER:
            if order:
                return None
            order = _ORDER[t]
        elif t == "+":
            return None
        elif t[0] == "%" or t.isdigit():
            if last < 0:
                return None
            if t in rings:
                other, o = rings.pop(t)
                if other == last or (o and order and o != order):
                    return None
                both = mol.aromatic[other] and mol.aromatic[last]
                mol.bonds.append((other, last, o or order or (4 if both else 1)))
            else:
                rings[t] = (last, order)
            order = 0
        else:
            if t[0] == "[":
                hit = _ATOM.match(t)
                if not hit:
                    return None
                name, h, q = hit[2], hit[4], hit[5]
                hydrogens = 0 if h is None else int(h or 1)
                sign = -1 if q.startswith("-") else 1
                charge = 0 if not q else sign * (int(q[1:]) if q[1:].isdigit() else len(q))
                fixed.append(True)
            else:
                name, hydrogens, charge = t, 0, 0
                fixed.append(False)
            aromatic = name[0].islower()
            symbol = name.capitalize()
            if symbol not in WEIGHT:
                return None
            mol.symbol.append(symbol)
            mol.aromatic.append(aromatic)
            mol.charge.append(charge)
            mol.hydrogens.append(hydrogens)
            here = len(mol.symbol) - 1
            if last >= 0:
                mol.bonds.append((last, here, order or (4 if aromatic and mol.aromatic[last] else 1)))
            last, order = here, 0
    if stack or rings or order or not mol.symbol:
        return None
    for i, nb in enumerate(mol.neighbours()):
        if fixed[i]:
            continue
        used, usual = sum(1 if o == 4 else o for _, o in nb), VALENCES[mol.symbol[i]]
        if mol.aromatic[i]:  # one bond more in the ring system, unless a lone pair or a double bond outside serves it
            if used > usual[-1]:
                return None
            mol.hydrogens[i] = max(usual[0] - used - 1, 0)
            continue
        fits = [v for v in usual if v >= used]
        if not fits:
            return None
        mol.hydrogens[i] = fits[0] - used
    return mol


def ring_atoms(mol: Molecule) -> list[bool]:
    """Atoms in a ring: those with a bond that is no bridge."""
    nb = mol.neighbours()
    seen, low, inside, clock = [-1] * len(nb), [0] * len(nb), [False] * len(nb), 0
    for root in range(len(nb)):
        if seen[root] >= 0:
            continue
        seen[root] = low[root] = clock
        clock += 1
        walk = [(root, -1, iter(nb[root]))]
        while walk:
            i, parent, it = walk[-1]
            step = next(it, None)
            if step is None:
                walk.pop()
                if parent >= 0:
                    low[parent] = min(low[parent], low[i])
                    if low[i] <= seen[parent]:
                        inside[i] = inside[parent] = True
                continue
            j = step[0]
            if j == parent:
                continue
            if seen[j] < 0:
                seen[j] = low[j] = clock
                clock += 1
                walk.append((j, i, iter(nb[j])))
            else:
                low[i] = min(low[i], seen[j])
                inside[i] = inside[j] = True
    return inside


def properties(mol: Molecule) -> dict[str, float]:
    nb = mol.neighbours()
    weight = sum(WEIGHT[s] + h * WEIGHT["H"] for s, h in zip(mol.symbol, mol.hydrogens))
    polar = 0.0
    for i, s in enumerate(mol.symbol):
        top = max((1 if o == 4 else o for _, o in nb[i]), default=0)
        polar += POLAR.get((s, int(mol.aromatic[i]), mol.hydrogens[i], mol.charge[i], top, len(nb[i])), 0.0)
    hydroxyl = [i for i, s in enumerate(mol.symbol) if s == "O" and mol.hydrogens[i] == 1 and len(nb[i]) == 1]
    acid = sum(1 for i in hydroxyl if any(mol.symbol[k] == "O" and o == 2 for k, o in nb[nb[i][0][0]]))
    amine = sum(1 for i, s in enumerate(mol.symbol) if s == "N" and not mol.aromatic[i] and all(o == 1 for _, o in nb[i]) and all(not any(p == 2 for _, p in nb[j]) and not mol.aromatic[j] for j, _ in nb[i]))
    return {
        "mol_weight": weight,
        "heavy_atoms": sum(s != "H" for s in mol.symbol),
        "rings": len(mol.bonds) - len(mol.symbol) + 1,
        "donors": sum(s in "NO" and h > 0 for s, h in zip(mol.symbol, mol.hydrogens)),
        "acceptors": sum(s in "NO" for s in mol.symbol),
        "acids": acid,
        "amines": amine,
        "phenols": sum(1 for i in hydroxyl if mol.aromatic[nb[i][0][0]]),
        "polar_area": polar,
    }


def circular_bits(mol: Molecule, radius: int = RADIUS, bits: int = BITS) -> np.ndarray:
    """Circular fingerprint as 64-bit words: identifiers of every atom's surroundings up to the radius, folded."""
    nb, inside = mol.neighbours(), ring_atoms(mol)

    def mix(*x: int) -> int:
        return int.from_bytes(hashlib.blake2b(np.array(x, dtype=np.int64).tobytes(), digest_size=7).digest(), "little")

    ids = [mix(NUMBER[s], len(nb[i]), mol.hydrogens[i], mol.charge[i], int(inside[i])) for i, s in enumerate(mol.symbol)]
    found = set(ids)
    for r in range(1, radius + 1):
        ids = [mix(r, ids[i], *[v for pair in sorted((o, ids[j]) for j, o in nb[i]) for v in pair]) for i in range(len(ids))]
        found |= set(ids)
    words = np.zeros(bits // 64, np.uint64)
    for v in found:
        b = v % bits
        words[b // 64] |= np.uint64(1) << np.uint64(b % 64)
    return words.view(np.int64)


FIELDS = "valid boolean, mol_weight double, heavy_atoms int, rings int, donors int, acceptors int, acids int, amines int, phenols int, polar_area double, bits array<long>"


def describe(structures: DataFrame, column: str) -> DataFrame:
    """(column, valid, descriptors..., bits) for every distinct value of the column; invalid ones have nulls.

    Evaluate on distinct structures and join back: Catalyst wouldn't spare repeated calls.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[dict] = []
            for s in pdf[column]:
                mol = parse(s)
                out.append({column: s, "valid": mol is not None, "bits": None} | ({**properties(mol), "bits": circular_bits(mol)} if mol else {}))
            yield pd.DataFrame(out, columns=[column, *[f.split()[0] for f in FIELDS.split(", ")]]).astype({"bits": object} | {k: "Int32" for k in ("heavy_atoms", "rings", "donors", "acceptors", "acids", "amines", "phenols")})

    return structures.select(F.col(column).cast("string").alias(column)).distinct().mapInPandas(run, f"{column} string, {FIELDS}")
