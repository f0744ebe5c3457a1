"""Bounds, labels, orders of priority and enumerations that results are expressed in."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values.
LAT_MIN, LAT_MAX = 4.5, 21.5
LON_MIN, LON_MAX = 116.0, 127.0
COORD_PRIORITY = ("monitoring_validated", "osmapaaralan", "nsbi_2324", "geolocation_deped", "drrms_imrs")
LOCATION_PRIORITY = ("nsbi_2324", "geolocation_deped", "monitoring_validated", "osmapaaralan", "drrms_imrs")
LOCATION_COLS = ("region", "province", "municipality", "barangay")
ENROLMENT_COLS = ("school_management", "annex_status", "offers_es", "offers_jhs", "offers_shs", "shs_strand_offerings")
STATUSES = ("valid", "fixed_swap", "suspect", "no_coords", "out_of_bounds")
TRUSTED = ("valid", "fixed_swap")
REASONS = ("no_coordinate_source", "outside_all_polygons", "wrong_municipality", "placeholder_default", "coordinate_cluster", "round_coordinates", "invalid", "out_of_bounds", "no_submission", "not_in_lis")
PLACEHOLDERS = ((14.57929, 121.06494), (14.61789, 121.10269))
PLACEHOLDER_TOLERANCE = 0.001
CLUSTER_SIZE, DECIMALS = 3, 3
NEAR_KM, SIMILARITY = 0.1, 0.6
BUFFER_DEG = 0.002
DISCREPANCY_KM = 1.0
SCHOOL_YEARS = tuple(f"sy_{y}" for y in range(2005, 2025))
REGION_NAMES = {
    "region i (ilocos region)": "Region I",
    "region ii (cagayan valley)": "Region II",
    "region iii (central luzon)": "Region III",
    "region iv-a (calabarzon)": "Region IV-A",
    "mimaropa region": "MIMAROPA",
    "region v (bicol region)": "Region V",
    "region vi (western visayas)": "Region VI",
    "region vii (central visayas)": "Region VII",
    "region viii (eastern visayas)": "Region VIII",
    "region ix (zamboanga)": "Region IX",
    "region x (northern mindanao)": "Region X",
    "region xi (davao)": "Region XI",
    "region xii (soccsksargen)": "Region XII",
    "national capital region (ncr)": "NCR",
    "cordillera administrative region (car)": "CAR",
    "caraga": "CARAGA",
    "bangsamoro autonomous region in muslim mindanao (barmm)": "BARMM",
    "negros island region (nir)": "NIR",
}
NUMBERED_REGIONS = {
    "Region 01": "Region I", "Region 02": "Region II", "Region 03": "Region III", "Region 04-A": "Region IV-A", "Region 04-B": "MIMAROPA",
    "Region 05": "Region V", "Region 06": "Region VI", "Region 07": "Region VII", "Region 08": "Region VIII", "Region 09": "Region IX",
    "Region 10": "Region X", "Region 11": "Region XI", "Region 12": "Region XII",
}
PROVINCE_FIXES = {"MT. PROVINCE": "MOUNTAIN PROVINCE", "COTABATO": "NORTH COTABATO", "QUEZON PROVINCE": "QUEZON"}
OLD_REGIONS = {"negros occidental": "Region VI", "negros oriental": "Region VII", "siquijor": "Region VII"}
UPPER_NAMES = ("NCR", "CAR", "BARMM", "NIR", "CARAGA", "MIMAROPA")
STRANDS = {"abm": "ABM", "arts": "Arts and Design", "gas": "GAS", "humss": "HUMSS", "maritime": "Maritime", "sports": "Sports", "stem": "STEM", "tvl": "TVL", "unique": "Unique"}
ABBREVIATIONS = {"es": "elementary school", "ps": "primary school", "is": "integrated school", "nhs": "national high school", "shs": "senior high school"}
SAINTS = {"st": "saint", "sta": "santa", "sto": "santo"}
TRUST = {"monitoring_validated": "Highest", "osmapaaralan": "High", "nsbi_2324": "Moderate", "geolocation_deped": "Low", "tosf_self_reported": "Variable"}
# End of fixed values.


@dataclass(frozen=True)
class Box:
    """A closed range of latitudes and longitudes."""

    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX


BOX = Box()
RING_TYPE = "array<array<struct<x:double,y:double>>>"
