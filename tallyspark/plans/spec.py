"""KPI specifications as data.

A specification is a list of *families* (one aggregate over one look-back
window, with a column-name template) crossed with a list of *brands* (a brand
literal and the short code used in column names).  Individual cells may
override the brand literal they filter on or the column name they produce.
The KPI operator turns any specification into one two-stage aggregation; the
specification never becomes a chain of per-column jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# measure kinds a family can produce
SUM = "sum"            # total amount in the window
AVG = "avg"            # average amount per transaction row in the window
COUNT = "count"        # count of non-null transaction ids (lifetime when months is None)
ACTIVE = "active"      # 1 when the customer bought the brand inside the window, else NULL
INACTIVE = "inactive"  # 1 when the customer bought the brand but not inside the window, else NULL

MEASURES = (SUM, AVG, COUNT, ACTIVE, INACTIVE)


@dataclass(frozen=True)
class Family:
    """One aggregate family: ``outputs`` pairs each measure kind with a name template.

    Templates use ``{code}`` for the brand code.  A status family has two
    outputs (active, inactive) and therefore adds two columns per brand.
    """

    key: str
    months: int | None
    outputs: tuple[tuple[str, str], ...]

    def __post_init__(self):
        for measure, _ in self.outputs:
            if measure not in MEASURES:
                raise ValueError(f"unknown measure {measure!r}")
        if self.months is not None and self.months < 0:
            raise ValueError("months must be >= 0")


@dataclass(frozen=True)
class Brand:
    literal: str
    code: str


@dataclass(frozen=True)
class Cell:
    """One output column: measure of ``brand_literal`` over ``months``."""

    name: str
    measure: str
    months: int | None
    brand_literal: str


@dataclass(frozen=True)
class KpiSpec:
    families: tuple[Family, ...]
    brands: tuple[Brand, ...]
    # (family key, brand code) -> brand literal used instead of the brand's own
    brand_overrides: dict = field(default_factory=dict)
    # (family key, brand code, measure) -> column name used instead of the template's
    name_overrides: dict = field(default_factory=dict)

    def cells(self) -> list[Cell]:
        """Output columns in order: family by family, brand by brand, output by output."""
        out = []
        for fam in self.families:
            for brand in self.brands:
                literal = self.brand_overrides.get((fam.key, brand.code), brand.literal)
                for measure, template in fam.outputs:
                    name = self.name_overrides.get((fam.key, brand.code, measure),
                                                   template.format(code=brand.code))
                    out.append(Cell(name, measure, fam.months, literal))
        names = [c.name for c in out]
        if len(set(names)) != len(names):
            raise ValueError("KPI specification produces duplicate column names")
        return out

    def brand_literals(self) -> list[str]:
        """Every brand literal some cell filters on, first-seen order."""
        seen: dict[str, None] = {}
        for c in self.cells():
            seen.setdefault(c.brand_literal, None)
        return list(seen)

    def windows(self) -> list[int]:
        """Distinct look-back windows in months, ascending."""
        return sorted({f.months for f in self.families if f.months is not None})

    def select(self, measures=None, family_keys=None) -> "KpiSpec":
        """A sub-specification limited to some measures and/or families."""
        fams = []
        for fam in self.families:
            if family_keys is not None and fam.key not in family_keys:
                continue
            outs = tuple(o for o in fam.outputs if measures is None or o[0] in measures)
            if outs:
                fams.append(Family(fam.key, fam.months, outs))
        return KpiSpec(tuple(fams), self.brands, dict(self.brand_overrides), dict(self.name_overrides))

    def to_dict(self) -> dict:
        """A JSON-ready form: families, brands and the two override lists."""
        return {
            "families": [{"key": f.key, "months": f.months,
                          "outputs": [{"measure": m, "template": t} for m, t in f.outputs]}
                         for f in self.families],
            "brands": [{"literal": b.literal, "code": b.code} for b in self.brands],
            "brand_overrides": [{"family": k[0], "code": k[1], "literal": v}
                                for k, v in self.brand_overrides.items()],
            "name_overrides": [{"family": k[0], "code": k[1], "measure": k[2], "name": v}
                               for k, v in self.name_overrides.items()],
        }

    @classmethod
    def from_dict(cls, doc: dict) -> "KpiSpec":
        """Inverse of ``to_dict`` (e.g. a specification kept in a JSON file)."""
        fams = tuple(Family(f["key"], f.get("months"),
                            tuple((o["measure"], o["template"]) for o in f["outputs"]))
                     for f in doc["families"])
        brands = tuple(Brand(b["literal"], b["code"]) for b in doc["brands"])
        bo = {(o["family"], o["code"]): o["literal"] for o in doc.get("brand_overrides", [])}
        no = {(o["family"], o["code"], o["measure"]): o["name"] for o in doc.get("name_overrides", [])}
        return cls(fams, brands, bo, no)

    def with_brands(self, brands, brand_overrides=None) -> "KpiSpec":
        """Same families and name overrides over other brand literals."""
        return KpiSpec(self.families, tuple(brands),
                       dict(brand_overrides or {}), dict(self.name_overrides))
