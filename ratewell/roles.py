"""Names of the columns that play a role in an exposure table."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The ten shares of hours by kind of work.
SHARE_COLUMNS = (
    "PCT_HRS_UNDERGROUND",
    "PCT_HRS_SURFACE",
    "PCT_HRS_STRIP",
    "PCT_HRS_AUGER",
    "PCT_HRS_CULM_BANK",
    "PCT_HRS_DREDGE",
    "PCT_HRS_OTHER_SURFACE",
    "PCT_HRS_SHOP_YARD",
    "PCT_HRS_MILL_PREP",
    "PCT_HRS_OFFICE",
)


@dataclass(frozen=True)
class Roles:
    """Maps each role to a column name, so no operator is tied to one data set."""

    key: str = "MINE_ID"
    period: str = "YEAR"
    count: str = "NUM_INJURIES"
    exposure: str = "EMP_HRS_TOTAL"
    rate: str = "INJ_RATE_PER2K"
    status: str = "MINE_STATUS"
    status_group: str = "ADJ_STATUS"
    size: str = "AVG_EMP_TOTAL"
    state: str = "US_STATE"
    commodity: str = "COMMODITY"
    kind: str = "TYPE_OF_MINE"
    labels: str = "PRIMARY_LABELS"
    height: str = "SEAM_HEIGHT"
    shares: tuple[str, ...] = SHARE_COLUMNS
    underground: str = "PCT_HRS_UNDERGROUND"
    surface: str = "PCT_HRS_SURFACE"
    strip: str = "PCT_HRS_STRIP"
    mill: str = "PCT_HRS_MILL_PREP"
    office: str = "PCT_HRS_OFFICE"
    unit: float = 2000.0

    def with_columns(self, **names: str) -> "Roles":
        return replace(self, **names)


MINE = Roles()
