"""Fixed values that must equal the reference pipelines for identical results.

They are stated here once, plainly and in their natural order.
"""

# --- fixed values -----------------------------------------------------------

# Sentinel written by the listing producer when a district could not be mapped.
DISTRICT_SENTINEL = "TODO_MAPPING"

# Cities excluded from the listing fact table.
CITY_BLACKLIST = ("清远", "西安", "武汉", "青岛", "成都", "重庆")

# Floor level label -> relative floor height; anything else is 0.0.
FLOOR_RATIOS = {"低楼层": 0.25, "中楼层": 0.5, "高楼层": 0.75}
FLOOR_RATIO_DEFAULT = 0.0

# Ring road in the free-text location description (first capture group).
RING_ROAD_PATTERN = "([一二三四五六]环(?:至[一二三四五六]环)?)"

# Price ranges in units of 10k CNY: half-open [lo, hi), last one open-ended.
PRICE_EDGES = (100, 200, 300, 400, 500, 600, 700, 800, 900, 1000)
PRICE_LABELS = ("0-100万", "100-200万", "200-300万", "300-400万", "400-500万",
                "500-600万", "600-700万", "700-800万", "800-900万", "900-1000万",
                "1000万以上")

# Build-year segments; NULL years get the "unknown" label.
YEAR_EDGES = (1990, 2000, 2010)
YEAR_LABELS = ("1990前", "1990-2000", "2000-2010", "2010后")
YEAR_UNKNOWN = "未知"

# Click behaviours and their funnel step names.
BEHAVIORS = ("pv", "buy", "cart", "fav")
FUNNEL_STEPS = {"pv": "1-浏览(PV)", "fav": "2-收藏(Fav)", "cart": "3-加购(Cart)",
                "buy": "4-购买(Buy)"}

# Click log plausibility window for epoch seconds (inclusive).
TS_MIN, TS_MAX = 900000000, 2000000000

# Stream timing.
WATERMARK_DELAY = "3 seconds"
WINDOW_SIZE = "10 minutes"

# Writer target file size (bytes) and listing header default version.
TARGET_FILE_BYTES = 134217728
DEFAULT_VERSION = "1.1"

# Top-N sizes of the ranked application tables and of the hot-tag arrays.
TOP_HOUSES_PER_CITY = 10
HOT_COMMUNITY_CUTOFF = 100
HOT_TAGS_N = 5

# Default accuracy of percentile_approx.
MEDIAN_ACCURACY = 10000
