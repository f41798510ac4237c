"""Fixed values that must equal the reference job parameters for equal results.

Fixed values (do not change; they define grid origins, district codes and the
projection of the national grid):
"""

from __future__ import annotations

# --- fixed values: district (gu) codes of Incheon, in the order the female-population job lists them
DISTRICTS: list[tuple[str, str]] = [
    ("Bupyeong-gu", "28237"),
    ("Dong-gu", "28140"),
    ("Jung-gu", "28110"),
    ("Gyeyang-gu", "28245"),
    ("Namdong-gu", "28200"),
    ("Yeonsu-gu", "28185"),
    ("Michuhol-gu", "28177"),
    ("Seo-gu", "28260"),
    ("Ganghwa-gun", "28710"),
    ("Ongjin-gun", "28720"),
]

# --- fixed values: Incheon 50 m lattice origin (x counted rightward, y upward)
IC_MIN_X = "746758.991784"
IC_MIN_Y = "1883404.14739"

# --- fixed values: bounded national lattice origin (x rightward from PCELL_X, y downward from PCELL_Y)
PCELL_X = "1077058.991787"
PCELL_Y = "1780604.147390"
PCELL_MAX_ROW = 910  # largest second index kept by the bound test
CELL_SIZE = 50
HALF_CELL = 25

# --- fixed values: CCTV bounding box in degrees
CCTV_LO_MIN, CCTV_LO_MAX = "128.351", "128.761"
CCTV_LA_MIN, CCTV_LA_MAX = "35.608", "36.016"

# --- fixed values: grid id format and hour labels
GRID_ID_FORMAT = "GRID%06d"
HOURS: list[str] = [f"{h:02d}" for h in range(24)]
KINDS: list[str] = ["h", "w", "v"]  # resident, worker, visitor
SEXES: list[str] = ["m", "w"]
AGES: list[str] = ["10", "20", "30", "40", "50", "60", "70"]

# --- fixed values: EPSG:5179 (Korea 2000 unified CS), transverse Mercator on GRS80
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
TM_LAT0_DEG = 38.0
TM_LON0_DEG = 127.5
TM_K0 = 0.9996
TM_FALSE_EASTING = 1000000.0
TM_FALSE_NORTHING = 2000000.0

# Columns of the fact table and of the grid dimension, in their order.
FACT_COLUMNS = ["stdr_de", "stdr_tm", "grid_id", "admd_cd", "gu_cd", "fpop_co", "pt_stdr_ym"]
GRID_COLUMNS = [
    "grid_id", "row_no", "clm_no", "mtr_no", "admd_cd", "cnt_x_crd", "cnt_y_crd", "min_x_crd", "min_y_crd",
    "max_x_crd", "max_y_crd", "cnt_lo", "cnt_la", "min_lo", "min_la", "max_lo", "max_la", "cctv_co",
]
