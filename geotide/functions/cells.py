"""A hierarchical grid of the globe with 64-bit cell ids, as JVM expressions.

The id has the familiar layout of hierarchical cell indexes: mode 1 in bits
59 to 62, the resolution in bits 52 to 55, a base cell in bits 45 to 51, and
one three-bit digit for each resolution from 1 to 15, those beyond the cell's
own resolution being 7.  Hence a parent is pure bit arithmetic and the hex
form has 15 digits.

The grid itself is our own: 6 x 12 base cells of 30 degrees, each resolution
cuts a cell into 2 x 3 (odd) or 3 x 2 (even) latitude by longitude.  It is not
H3: the icosahedral tables that H3 needs aren't derivable here, and a cell of
this grid must not be mixed with ids of that system.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_ROWS, BASE_COLS, RESOLUTIONS = 6, 12, 15


def _cuts(res: int) -> list[tuple[int, int]]:
    return [(2, 3) if r % 2 else (3, 2) for r in range(1, res + 1)]


def _bits(places: range, per_base: int, cuts: list[int], weights: list[int], base_weight: int, step: int = 1) -> list[int]:
    """What each place along one axis (``step`` apart) adds to the id: its part of the base cell and of every digit."""
    out = []
    for i in places:
        at, left = i * step, per_base
        bits = (at // left) * base_weight << 45
        for r, (cut, weight) in enumerate(zip(cuts, weights, strict=True), 1):
            left //= cut
            bits += (at // left % cut) * weight << 3 * (RESOLUTIONS - r)
        out.append(bits)
    return out


def cell(lat: Column, lon: Column, res: int = 7) -> Column:
    """Cell id of a position in degrees; null outside the globe.

    Every digit is a sum of one part from the latitude's place and one from the
    longitude's, so an id is a sum of table entries: for each axis one of the
    place's upper digits and one of its lower ones.
    """
    cuts = _cuts(res)
    ids = F.lit((1 << 59) | (res << 52) | (1 << 3 * (RESOLUTIONS - res)) - 1)
    for value, span, n_base, axis, base_weight in ((lat + 90.0, 180.0, BASE_ROWS, 0, BASE_COLS), (lon + 180.0, 360.0, BASE_COLS, 1, 1)):
        own, weights = [c[axis] for c in cuts], [c[1] if axis == 0 else 1 for c in cuts]
        per_base, low = math.prod(own), math.prod(own[(res + 1) // 2 :])
        place = F.least(F.floor(value / span * (n_base * per_base)), F.lit(n_base * per_base - 1)).cast("int")
        table = lambda places, step: F.array(*[F.lit(x).cast("long") for x in _bits(places, per_base, own, weights, base_weight, step)])  # noqa: B023, E731
        ids = ids + F.get(table(range(n_base * per_base // low), low), (place / low).cast("int")) + F.get(table(range(low), 1), F.pmod(place, F.lit(low)))
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), ids)


def parent(cell_id: Column, res: Column | int) -> Column:
    """The cell's ancestor at a coarser (or its own) resolution."""
    res = F.lit(res) if isinstance(res, int) else res
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (3 * (RESOLUTIONS - res)).cast("int")) - 1
    plain = cell_id.bitwiseAND(F.lit(~(15 << 52)))
    return plain.bitwiseOR(F.call_function("shiftleft", res.cast("long"), F.lit(52))).bitwiseOR(mask)


def cell_hex(cell_id: Column) -> Column:
    return F.lower(F.hex(cell_id))
