"""Identifiers, checksums, hashes and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_field, col, collapse, vectorized


def padded_application(x: Column | str) -> Column:
    """US + year + serial + kind: the serial of applications is padded to seven digits, grants stay."""
    year, serial, kind = (F.regexp_extract(col(x), r"^US((?:19|20)\d\d)(\d{1,7})(A\d)$", g) for g in (1, 2, 3))
    return F.when(year != "", F.concat(F.lit("US"), year, F.lpad(serial, 7, "0"), kind)).otherwise(col(x))


def publication_key(x: Column | str) -> Column:
    """kind and number, so that spellings compare; null outside the US."""
    number = F.regexp_extract(F.regexp_replace(col(x), "-", ""), r"^US(?:RE|D|PP)?0*(\d+)", 1)
    return F.when(number != "", F.struct(F.when(F.rlike(col(x), F.lit("A\\d$")), "application").otherwise("grant").alias("kind"), number.cast("long").alias("number")))


def canonical(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(col(x), "-", ""), "^US0*", "US")


def era(number: Column | str, bounds: tuple[int, ...]) -> Column:
    """How many of the rising bounds a number has reached."""
    out = F.lit(0)
    for b in bounds:
        out = out + F.when(col(number) >= b, 1).otherwise(0)
    return out


def publication_rank(x: Column | str) -> Column:
    """Grants first, then by number, then by text; what isn't a number comes last."""
    number = F.regexp_extract(col(x), r"^[A-Z]+(\d+)", 1)
    return F.struct((~F.rlike(col(x), F.lit(r"B\d?$"))).alias("later"), F.when(number == "", F.lit(10**12)).otherwise(number.try_cast("bigint")).alias("number"), col(x).alias("id"))


def registry_number_ok(x: Column | str) -> Column:
    """Seven digits nnn-nnn-c whose check digit is the sum of digit times place, modulo 11."""
    digits = F.regexp_replace(col(x), "-", "")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(6)), F.lit(0), lambda s, i: s + i * F.substring(digits, i, F.lit(1)).try_cast("int"))
    return F.rlike(col(x), F.lit(r"^\d{3}-\d{3}-\d$")) & (total % 11 == F.substring(digits, 7, 1).try_cast("int"))


def identifiers(names: Column, pattern: str) -> Column:
    """Those of a list that look like an identifier, each once, in order."""
    return F.array_distinct(F.filter(names, lambda n: F.rlike(n, F.lit(pattern))))


def code_list(x: Column | str) -> Column:
    """Codes between commas or semicolons, without what stands in brackets."""
    return F.filter(F.transform(F.split(F.regexp_replace(col(x), r"\([^)]*\)", ""), "[,;]"), lambda c: collapse(c)), lambda c: c != "")


def evidence_id(*fields: Column | str) -> Column:
    """Twelve hex digits of the SHA-1 of cleaned fields between bars."""
    return F.substring(F.sha1(F.concat_ws("|", *(clean_field(f) for f in fields)).cast("binary")), 1, 12)


def connectivity(key: Column | str) -> Column:
    return F.substring(col(key), 1, 14)


def without_stereo(key: Column | str) -> Column:
    return F.contains(col(key), F.lit("-UHFFFAOYSA-"))


def word_count(x: Column | str) -> Column:
    trimmed = collapse(x)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " ")))


def round_half_even(x: Column | str, digits: int) -> Column:
    return F.bround(col(x), digits)


def norm2(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


def rescaled(x: Column | str, low: Column, high: Column) -> Column:
    """0 at low, 1 at high, clipped."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(col(x) - low, high - low)))


def gap_seconds(header: Column | str) -> Column:
    """Seconds between requests that a header "search=colour:n" allows; null if it says nothing."""
    n = F.regexp_extract(col(header), r"search=\w+:(\d+)", 1)
    return F.when(n != "", F.try_divide(F.lit(60.0), n.try_cast("double")))


def log_midpoint(a: Column | str, b: Column | str) -> Column:
    return F.exp((F.ln(col(a)) + F.ln(col(b))) / 2)


# Average atomic masses.
MASSES = {"H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "P": 30.974, "S": 32.06, "Cl": 35.45, "Br": 79.904, "I": 126.904}
VALENCES = {"B": 3, "C": 4, "N": 3, "O": 2, "F": 1, "P": 3, "S": 2, "Cl": 1, "Br": 1, "I": 1}


Atom = tuple[str, int, bool, int]
Bond = tuple[int, int, float]


def molecule_of(smiles: str) -> tuple[list[Atom], list[Bond]] | None:
    """Atoms (element, hydrogens, aromatic, charge) and bonds (two atoms, order) of a molecule written as SMILES; None if it can't be read."""
    import re

    atoms: list[list] = []  # element, hydrogens (None: by valence), sum of bond orders, aromatic, charge
    bonds: list[Bond] = []
    stack: list[int] = []
    rings: dict[str, tuple[int, float]] = {}
    last, order, at = -1, 0.0, 0
    token = re.compile(r"\[(\d*)([A-Za-z][a-z]?)(@{0,2})(H\d*)?([+-]+\d*)?(?::\d+)?\]|(Cl|Br|[BCNOPSFI]|[bcnops])|([-=#:/\\.])|(\()|(\))|(%\d\d|\d)")

    def bind(a: int, b: int, written: float) -> None:
        bond = written or (1.5 if atoms[a][3] and atoms[b][3] else 1.0)
        atoms[a][2] += bond
        atoms[b][2] += bond
        bonds.append((a, b, bond))

    while at < len(smiles):
        m = token.match(smiles, at)
        if not m:
            return None
        at = m.end()
        if m[2] or m[6]:
            symbol, sign = m[2] or m[6], m[5] or ""
            hydrogens = None if m[6] else 0 if not m[4] else int(m[4][1:] or 1)
            size = int(re.sub(r"\D", "", sign) or len(sign))
            atoms.append([symbol.capitalize(), hydrogens, 0.0, symbol[0].islower(), -size if "-" in sign else size])
            if last >= 0:
                bind(last, len(atoms) - 1, order)
            last, order = len(atoms) - 1, 0.0
        elif m[7]:
            if m[7] == ".":
                last, order = -1, 0.0
            else:
                order = {"=": 2.0, "#": 3.0, ":": 1.5}.get(m[7], 1.0)
        elif m[8]:
            stack.append(last)
        elif m[9]:
            if not stack:
                return None
            last = stack.pop()
        elif last < 0:
            return None
        else:
            if m[10] in rings:
                other, first = rings.pop(m[10])
                bind(last, other, order or first)
            else:
                rings[m[10]] = (last, order)
            order = 0.0
    if rings or stack:
        return None
    out = []
    for symbol, hydrogens, used, aromatic, charge in atoms:
        if symbol not in MASSES and symbol != "B":
            return None
        if hydrogens is None:
            valence, whole = VALENCES[symbol], int(used + (0.5 if aromatic and used % 1 else 0))
            if symbol in ("S", "P"):
                while valence < whole:
                    valence += 2
            hydrogens = max(0, valence - whole)
        out.append((symbol, hydrogens, aromatic, charge))
    return out, bonds


def formula_of(smiles: str) -> tuple[str, float] | None:
    """Hill formula and mass of a molecule written as SMILES; None if it can't be read."""
    read = molecule_of(smiles)
    if read is None:
        return None
    count: dict[str, int] = {}
    for symbol, hydrogens, *_ in read[0]:
        count[symbol] = count.get(symbol, 0) + 1
        count["H"] = count.get("H", 0) + hydrogens
    count = {k: v for k, v in count.items() if v}
    first = ["C", "H"] if "C" in count else []
    ordered = [e for e in first if e in count] + sorted(e for e in count if e not in first)
    return "".join(e + (str(count[e]) if count[e] > 1 else "") for e in ordered), round(sum(MASSES.get(e, 10.81) * n for e, n in count.items()), 3)


# Outer electrons.
OUTER = {"H": 1, "B": 3, "C": 4, "N": 5, "O": 6, "F": 7, "P": 5, "S": 6, "Cl": 7, "Br": 7, "I": 7}
DESCRIPTORS = ("heavy_atoms", "n_carbon", "n_oxygen", "n_nitrogen", "n_sulfur", "n_halogen", "heteroatoms", "h_donors", "rings", "valence_electrons")


def descriptors_of(smiles: str) -> tuple | None:
    """The numbers of DESCRIPTORS and the share of carbons with four single bonds; None if the molecule can't be read."""
    read = molecule_of(smiles)
    if read is None:
        return None
    atoms = [(at, *a) for at, a in enumerate(read[0]) if a[0] != "H"]
    flat = {at for a, b, order in read[1] if order != 1.0 for at in (a, b)}
    root = list(range(len(read[0])))

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    closed = 0  # a bond between two atoms that hang together already closes a ring
    for a, b, _ in read[1]:
        x, y = top(a), top(b)
        closed += x == y
        root[x] = y
    count = lambda *symbols: sum(a[1] in symbols for a in atoms)
    donates = lambda symbol, h, aromatic, charge: h > 0 and charge in (0, 1) if symbol == "N" and not aromatic else symbol in ("N", "O", "S") and h == 1 and charge == 0
    sp3 = sum(a[1] == "C" and not a[3] and a[0] not in flat for a in atoms)
    electrons = sum(OUTER[s] - charge + h for _, s, h, _, charge in atoms)
    whole = (len(atoms), count("C"), count("O"), count("N"), count("S"), count("F", "Cl", "Br", "I"), len(atoms) - count("C"), sum(donates(*a[1:]) for a in atoms), closed, electrons)
    return *whole, round(sp3 / count("C"), 4) if count("C") else 0.0


def smiles_descriptors(x: Column | str) -> Column:
    """The numbers of descriptors_of for each molecule; all null where it can't be read."""
    import pandas as pd

    names = [*DESCRIPTORS, "fraction_csp3"]

    def run(s):  # type: ignore[no-untyped-def]
        rows = [descriptors_of(t) if t else None for t in s]
        return pd.DataFrame([r or [None] * len(names) for r in rows], columns=names).astype({n: "Int64" for n in DESCRIPTORS} | {"fraction_csp3": "Float64"})

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return vectorized(f"struct<{', '.join(f'{n}: bigint' for n in DESCRIPTORS)}, fraction_csp3: double>")(run)(col(x))


def smiles_formula(x: Column | str) -> Column:
    """formula and mass of each molecule; both null where it can't be read."""
    import pandas as pd

    def run(s):  # type: ignore[no-untyped-def]
        return pd.DataFrame([formula_of(t) or (None, None) if t else (None, None) for t in s], columns=["formula", "mass"])

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return vectorized("struct<formula: string, mass: double>")(run)(col(x))


def utc_stamp(ts: Column | str | None = None) -> Column:
    """ISO 8601 in UTC; of now, if no timestamp is given (then it doesn't belong into compared output)."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if ts is None else col(ts), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def hours_left(left: Column | str, delay: float) -> Column:
    """Hours that so many requests take at half the greatest delay each."""
    return col(left) * delay / 2 / 3600


def response_class(status: Column | str, body: Column | str) -> Column:
    """What a service's answer means for the caller: ok, gone (never ask again), quota, forbidden, retry."""
    low = F.lower(F.coalesce(col(body), F.lit("")))
    return F.when(col(status).between(200, 299), "ok").when(col(status).isin(404, 410), "gone").when((col(status) == 403) & F.rlike(low, F.lit("quota|too many|robot")), "quota").when(col(status) == 403, "forbidden").otherwise("retry")


def renamed_keys(m: Column | str, names: dict[str, str]) -> Column:
    """A map with some of its keys renamed."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.transform_keys(col(m), lambda k, _: F.coalesce(F.try_element_at(table, k), k))
