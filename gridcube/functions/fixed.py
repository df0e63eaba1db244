"""Fixed values that must equal the published ones for results to agree."""

# The missing-data sentinel of the raw files.
RAW_FILL = -999.0

# The origin and calendar of stored day numbers.
EPOCH = "1900-01-01"
TIME_UNITS = "days since 1900-01-01"
CALENDAR = "proleptic_gregorian"

# Plausible bounds per canonical unit, inclusive.
BOUNDS_BY_UNITS = {
    "mm d-1": (-50.0, 200.0),
    "W m-2": (-1000.0, 1000.0),
    "m3 m-3": (0.0, 1.0),
    "unitless": (0.0, 1.0),
}

# Totals and the components that add up to them.
IDENTITIES = {
    "E": ("Eb", "Ec", "Ei", "Es", "Et", "Ew"),
    "Ep": ("Ep_aero", "Ep_rad"),
}
IDENTITY_TOLERANCE = 1e-4

# The smallest acceptable share of a chunk's size, per layout.
DEGENERATE_FRACTION = {"spatial": 0.002, "temporal": 0.0}

# Global attributes in which two layouts of one variable may differ.
LAYOUT_ATTRS = (
    "title",
    "chunking",
    "history",
    "date_created",
    "related_store",
    "known_data_gaps",
    "verification",
)

# Attributes every data variable must carry.
REQUIRED_ATTRS = ("standard_name", "long_name", "units")

# Build defaults.
STEPS_PER_COMMIT = 100
STRATEGIES = ("append", "region")
BRANCH = "main"
SKELETON_MESSAGE = "create skeleton"
BATCH_MESSAGE = "write timesteps {first}-{last}"
BLOCK_MESSAGE = "write {variable} lat[{i0}:{i1}) lon[{j0}:{j1})"
BLOCK_PATTERN = r"^write (\S+) lat\[(\d+):(\d+)\) lon\[(\d+):(\d+)\)$"

# Verification defaults.
VERIFY_DEFAULTS = {
    "samples": 42,
    "seed": 20260910,
    "identity_days": 4,
    "range_days": 6,
    "smallest": 3,
    "trace_absent": 24,
    "mask_days": 12,
}
DIGESTS = ("raw", "store", "off")  # ours: what every chunk's digest is compared with
PHASES = ("structure", "index", "samples", "sweep", "identities", "ranges", "metadata")
