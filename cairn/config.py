"""Fixed values and thresholds of the catalog engine."""
from __future__ import annotations

# They must hold for results to agree with the published rules.
AUTO_ACCEPT, REVIEW_FLOOR, ATTRIBUTE_FLOOR = 92, 84, 90
PHONETIC_GUARD, LEAF_SNAP = 85, 80
FILL_WARN, FILL_FAIL, ROW_FLOOR = 0.15, 0.40, 0.50
SHAPE_WARN, SHAPE_FAIL, VALUE_SET_WARN = 0.2, 0.5, 0.2
STAGE_DEGRADED = {"normalise": 0.25, "match": 0.50, "derive": 0.25, "validate": 0.50, "images": 0.25}
GATE_WARN, GATE_FAIL = 0.5, 0.9
DRIFT_WARN, DRIFT_FAIL, DRIFT_MIN_ROWS = 4.0, 10.0, 8
ALIAS_FLOOR, ALIAS_ACCEPT, ALIAS_MINT, DESPACED_GUARD = 70, 0.90, 0.20, 0.90
CLEAN_RUNS, HISTORY = 3, 20
DELIST_CAP, ADAPT_LOSS_CAP = 0.30, 0.50
ATTRIBUTES = ("type", "color", "finish", "quality")
CATEGORIES = {"slab": "0.0017", "block": "0.0014348", "tile": "0.0014348"}
AMBIGUOUS_TYPE_WORDS = ("crystal", "quartz", "agate", "amethyst", "coral")
FALLBACK_COLOR, BLOCK_FINISH, LAST_QUALITY = "Natural", "Raw", "A"
LAST_FINISH = {"slab": "Polished", "tile": "Honed"}
DIMENSIONS = {"slab": (3.30, 2.00, 0.02), "block": (2.80, 1.50, 1.50), "tile": (0.60, 0.60, 0.02)}
DENSITY, SLAB_AREA = 2700.0, 5.0
NAMESPACE = "6f9619ff-8b86-d011-b42d-00cf4fc964ff"
BLOCK_SLOTS, PRODUCT_SLOTS = 4, 15
PAGE, PAGE_MOST, LEASE_SECONDS, DEAD_LETTER = 500, 2000, 900, 5
INVENTORY_CAP = 1_000_000
STATUS_RANK = {"OK": 0, "DEGRADED": 1, "FAILED": 2}
CONFIDENCE = {"none": 0, "low": 1, "medium": 2, "high": 3}
FRAMEWORK_COLUMNS = ("format", "image_count", "image_urls", "image_filenames_local", "scrape_timestamp", "raw_json", "fetch_failed")
SWAP_LEAST, SWAP_LEAD = 5, 0.4
