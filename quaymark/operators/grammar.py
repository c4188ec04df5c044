"""The columns of a feature matrix: which family, venue and role each has, and which are missing.

A family's columns are there for a venue or not as a whole, by whether the venue published the
stream behind them that date.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from .features import DEPTH_RUNGS, FLOW_WINDOWS, HORIZONS, RETURN_WINDOWS

KEY, LEVEL, FEATURE, TARGET, CLOCK = "key", "level", "feature", "target", "diagnostic"


def _over(name: str, windows: Iterable[int]) -> list[str]:
    return [f"{name}_{w}" for w in windows]


#: Family, the stream it comes from, and its columns by role.
PER_VENUE: dict[str, tuple[str, dict[str, list[str]]]] = {
    "book": ("quotes", {LEVEL: ["mid", "bid", "ask"], FEATURE: ["bid_sz", "ask_sz", "spread_bps", "imbalance", "micro_dev",
    *_over("depth_imb", DEPTH_RUNGS), "bid_span_bps", "ask_span_bps",
                                                              "depth_10"], CLOCK: ["age_ms"]}),
    "ofi": ("quotes", {FEATURE: ["ofi", *_over("ofi", FLOW_WINDOWS)]}),
    "returns": ("quotes", {FEATURE: _over("ret_bps", RETURN_WINDOWS)}),
    "flow": ("trades", {FEATURE: ["signed_vol", "volume", "n_trades", *_over("signed_vol", FLOW_WINDOWS), *_over("volume", FLOW_WINDOWS)],
    LEVEL: ["vwap"]}),
    "basis": ("mark_price", {FEATURE: ["basis_bps", "funding_rate", "funding_in_s", *_over("basis_chg", FLOW_WINDOWS)],
    CLOCK: ["mark_age_ms"]}),
    "open_interest": ("open_interest", {FEATURE: _over("oi_chg_bps", FLOW_WINDOWS), CLOCK: ["oi_age_ms"]}),
    "liquidations": ("liquidations", {FEATURE: ["liq_flow", "n_liqs", *_over("liq_flow", FLOW_WINDOWS), *_over("n_liqs", FLOW_WINDOWS)]}),
}
GOALS = [*_over("ret_bps", HORIZONS), *_over("dz", HORIZONS)]
CONSOLIDATED = {"nbbo_mid": LEVEL, "nbbo_spread_bps": FEATURE, "nbbo_n_venues": FEATURE, "nbbo_age_ms": CLOCK}


@dataclass(frozen=True)
class Named:
    """What a column is."""

    name: str
    family: str
    role: str
    venue: str | None = None


_TAILS = {c: (family, role) for family, (_, roles) in PER_VENUE.items() for role, cols in roles.items() for c in cols}


def classify(name: str) -> Named:
    """The family, role and venue of a column name; a name of no family is an error.

    A venue's name may hold underscores, and one family's column may end in another's: the longest
    tail that is a family's column is meant, which is the first found from the left."""
    if name in ("ts_ns", "date"):
        return Named(name, "grid", KEY)
    if name in CONSOLIDATED:
        return Named(name, "nbbo", CONSOLIDATED[name])
    if name.startswith("y_"):
        if name[2:] in GOALS:
            return Named(name, "target", TARGET)
        body, tails = name[2:], dict.fromkeys(GOALS, ("target", TARGET))
    else:
        body, tails = name, _TAILS
    for i, ch in enumerate(body):
        if ch == "_" and i and body[i + 1 :] in tails:
            return Named(name, *tails[body[i + 1 :]], body[:i])
    raise ValueError(f"{name!r} is a column of no family")


def expected(streams: Mapping[str, Iterable[str]]) -> list[Named]:
    """Every column of a matrix, from the streams that each venue published; names that collide are an error."""
    out = [Named("ts_ns", "grid", KEY), Named("date", "grid", KEY), *[Named(c, "nbbo", r) for c, r in CONSOLIDATED.items()],
        *[Named(f"y_{g}", "target", TARGET) for g in GOALS]]
    for venue in sorted(streams):
        have = set(streams[venue])
        for family, (stream, roles) in PER_VENUE.items():
            if stream in have:
                out += [Named(f"{venue}_{c}", family, role, venue) for role, cols in roles.items() for c in cols]
        if "quotes" in have:
            out += [Named(f"y_{venue}_{g}", "target", TARGET, venue) for g in GOALS]
    names = [c.name for c in out]
    if len(set(names)) < len(names):
        raise ValueError(f"venues collide on {sorted({n for n in names if names.count(n) > 1})}")
    return out


class Grammar:
    """The columns that a frame should have, recovered from those it has."""

    def __init__(self, columns: Iterable[str]) -> None:
        self.present = set(columns)
        self.streams: dict[str, set[str]] = {}
        for c in map(classify, sorted(self.present)):
            if c.venue is not None:
                self.streams.setdefault(c.venue, set()).add("quotes" if c.family == "target" else PER_VENUE[c.family][0])
        self.columns = {c.name: c for c in expected(self.streams)}

    @property
    def venues(self) -> list[str]:
        return sorted(self.streams)

    def features(self, columns: Iterable[str], without: str | None = None) -> list[str]:
        """Model inputs in the frame's order; without a venue's own view, and then without the consolidated
        book, which is made of that venue's quotes too."""
        inputs = [self.columns[c] for c in columns if self.columns[c].role == FEATURE]
        return [c.name for c in inputs if without is None or (c.venue != without and c.family != "nbbo")]

    def ages(self) -> tuple[list[str], list[str]]:
        """Age columns by the clock they run on: books, and all others, the consolidated book's among them."""
        clocks = [c for c in self.columns.values() if c.role == CLOCK and c.name in self.present]
        return [c.name for c in clocks if c.family == "book"], [c.name for c in clocks if c.family != "book"]

    def target(self, horizon: int, venue: str | None = None) -> str:
        return f"y_{venue}_ret_bps_{horizon}" if venue else f"y_ret_bps_{horizon}"

    def spread(self, venue: str | None = None) -> str:
        return f"{venue or 'nbbo'}_spread_bps"

    def missing(self) -> dict[str, list[str]]:
        """Columns that the frame should have and has not, by ``venue/family``."""
        out: dict[str, list[str]] = {}
        for c in self.columns.values():
            if c.name not in self.present:
                out.setdefault(f"{c.venue}/{c.family}" if c.venue else c.family, []).append(c.name)
        return out

    def tolerances(self, book_ms: float, tape_ms: float) -> dict[str, float]:
        """The most age of each age column, as :func:`quaymark.operators.features.clean` takes it."""
        book, tape = self.ages()
        return dict.fromkeys(book, book_ms) | dict.fromkeys(tape, tape_ms)
