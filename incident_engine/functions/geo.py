"""Plane geometry on plain double columns, as SQL expression text.

A ring is an array of ``(x, y)`` points whose first and last points are equal;
an edge is a struct ``(x1, y1, x2, y2)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from incident_engine.schemas import CELL_SIZE


@dataclass(frozen=True)
class GridSpec:
    """Square cells of ``step`` over ``[xmin, xmax] x [ymin, ymax]``."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float
    step: float = CELL_SIZE

    @property
    def nx(self) -> int:
        return ceil((self.xmax - self.xmin) / self.step)

    @property
    def ny(self) -> int:
        return ceil((self.ymax - self.ymin) / self.step)

    @property
    def width(self) -> str:
        return f"{self.step!r}D"

    def x_index(self, x: str) -> str:
        return f"cast(floor(({x} - ({self.xmin!r}D)) / {self.width}) as bigint)"

    def y_index(self, y: str) -> str:
        return f"cast(floor(({y} - ({self.ymin!r}D)) / {self.width}) as bigint)"

    def holds(self, x: str, y: str) -> str:
        """Is the point within the extent, edges included?"""
        return (f"{x} >= {self.xmin!r}D and {x} <= {self.xmax!r}D "
                f"and {y} >= {self.ymin!r}D and {y} <= {self.ymax!r}D")

    def left(self, ix: str = "ix") -> str:
        return f"({self.xmin!r}D + {ix} * {self.width})"

    def right(self, ix: str = "ix") -> str:
        """Right side of a column, which is the left side of the next one to the last bit."""
        return f"({self.xmin!r}D + ({ix} + 1) * {self.width})"

    def middle(self, iy: str = "iy") -> str:
        return f"({self.bottom(iy)} + {self.width} / 2)"

    def bottom(self, iy: str = "iy") -> str:
        return f"({self.ymin!r}D + {iy} * {self.width})"

    def box(self, ix: str = "ix", iy: str = "iy") -> dict[str, str]:
        x, y = self.left(ix), self.bottom(iy)
        return {"xmin": x, "ymin": y, "xmax": f"({x} + {self.width})", "ymax": f"({y} + {self.width})"}

    def columns_between(self, low: str, high: str) -> str:
        """Cell columns ``low..high`` cut to the grid, or null when they miss it."""
        return _indices(low, high, self.nx)

    def rows_between(self, low: str, high: str) -> str:
        return _indices(low, high, self.ny)


def _indices(low: str, high: str, count: int) -> str:
    first, last = f"greatest({low}, 0L)", f"least({high}, {count - 1}L)"
    return f"if({first} <= {last}, sequence({first}, {last}), null)"


def ring_edges(ring: str = "ring") -> str:
    """Array of the edges of a closed ring."""
    count = f"greatest(size({ring}) - 1, 0)"
    return (
        f"zip_with(slice({ring}, 1, {count}), slice({ring}, 2, {count}), (a, b) -> "
        "named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))"
    )


def inside_cell(grid: GridSpec, edges: str, odd: str, x: str, y: str) -> str:
    """Even-odd rule over the edges of all rings (so holes need no special case), by the edges that
    meet the point's cell ``ix, iy`` and the bit of its right side.

    The path runs from the point towards +x up to the right side of the cell, then on that side to
    its middle, where ``odd`` tells whether it is inside. Counted are the edges that the first part
    crosses and those that cross the side between the point's height and the middle. Where an edge
    is at a height is computed in one way, and an edge counts at its lower end but not at its upper
    one, so the answers are those of the rule over all edges to the last bit.
    """
    side = grid.right()

    def at(v: str) -> str:
        return f"(e.x2 - e.x1) * ({v} - e.y1) / (e.y2 - e.y1) + e.x1"

    def below(v: str) -> str:
        """Does the edge cross the side below the height? It is right of it above the crossing if
        it leans to the right, else below."""
        return (f"if((e.y1 > {v}) != (e.y2 > {v}), "
                f"({at(v)} > {side}) = ((e.x2 > e.x1) = (e.y2 > e.y1)), e.y1 <= {v})")

    crosses = f"(e.x1 > {side}) != (e.x2 > {side})"
    along = (f"if((e.y1 > {y}) != (e.y2 > {y}), "
             f"{at(y)} > {x} and if({crosses}, {at(y)} <= {side}, e.x1 <= {side}), false)")
    up = f"if({crosses}, {below(y)} != {below(grid.middle())}, false)"
    return (f"(size(filter({edges}, e -> {along})) + size(filter({edges}, e -> {up})) "
            f"+ if({odd}, 1, 0)) % 2 = 1")
