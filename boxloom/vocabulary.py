"""Fixed values of the domain: class names, alias phrases, class map, groups, thresholds.

Everything here is small and of a fixed size, so the frames built from it may
always be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the published label definitions) -------------

# Class names in collection order; the position is the class index.
COLLECTION_CLASSES = [
    "main_door", "room_door", "floor_window", "normal_window", "stove", "sink", "stairs",
    "water_feature", "broad_leaf_live", "sharp_leaf_live", "fake_plant", "bed", "sofa", "desk",
    "dining_table", "coffee_table", "mirror", "beam", "toilet", "cabinet",
]

# The same classes in review order (alphabetical).
REVIEW_CLASSES = sorted(COLLECTION_CLASSES)

# Order in which free-text labels are tried against the alias phrases.
ALIAS_PRIORITY = [
    "floor_window", "main_door", "room_door", "coffee_table", "dining_table", "sharp_leaf_live",
    "broad_leaf_live", "fake_plant", "water_feature", "normal_window", "stove", "sink", "stairs",
    "bed", "sofa", "desk", "mirror", "beam", "toilet", "cabinet",
]

# Alias phrases of each class.
ALIASES = {
    "main_door": ["front entry door", "front door", "entry door", "main entrance door"],
    "room_door": ["interior room door", "interior door", "room door", "bedroom door", "sliding door",
                  "pocket door"],
    "floor_window": ["floor to ceiling window", "full height window", "panoramic window"],
    "normal_window": ["standard window", "window", "casement window", "small window",
                      "double hung window"],
    "stove": ["kitchen stove", "stove", "gas stove", "cooktop", "range"],
    "sink": ["sink", "kitchen sink", "bathroom sink", "wash basin"],
    "stairs": ["staircase", "stairs", "stairway", "indoor steps"],
    "water_feature": ["indoor aquarium", "aquarium", "fish tank", "indoor fountain",
                      "indoor water feature"],
    "broad_leaf_live": ["broadleaf houseplant", "monstera plant", "fiddle leaf fig", "tropical plant"],
    "sharp_leaf_live": ["spiky houseplant", "cactus", "snake plant", "aloe vera", "succulent"],
    "fake_plant": ["artificial plant", "fake plant", "faux plant", "plastic plant", "dried plant"],
    "bed": ["bed", "bedroom bed", "mattress", "headboard bed"],
    "sofa": ["sofa", "couch", "sectional sofa", "loveseat"],
    "desk": ["desk", "office desk", "study desk", "computer desk"],
    "dining_table": ["dining table", "dining room table", "kitchen table"],
    "coffee_table": ["coffee table", "center table", "low table"],
    "mirror": ["wall mirror", "mirror", "full length mirror", "floor mirror"],
    "beam": ["ceiling beam", "exposed beam", "wooden beam", "structural beam"],
    "toilet": ["toilet", "bathroom toilet", "commode"],
    "cabinet": ["storage cabinet", "cabinet", "wardrobe", "cupboard", "bookshelf cabinet"],
}

# Prompt phrase of each class, used once per image in the joint prompt.
PHRASES = {
    "main_door": "front entry door", "room_door": "interior room door",
    "floor_window": "floor to ceiling window", "normal_window": "standard window",
    "stove": "kitchen stove", "sink": "sink", "stairs": "staircase",
    "water_feature": "indoor aquarium", "broad_leaf_live": "broadleaf houseplant",
    "sharp_leaf_live": "spiky houseplant", "fake_plant": "artificial plant", "bed": "bed",
    "sofa": "sofa", "desk": "desk", "dining_table": "dining table", "coffee_table": "coffee table",
    "mirror": "wall mirror", "beam": "ceiling beam", "toilet": "toilet",
    "cabinet": "storage cabinet",
}

# Prompt of the second, per-class pass.
FALLBACK_PROMPTS = {
    "main_door": "front door . main entrance door . entry door . apartment entrance door",
    "room_door": "interior door . room door . bedroom door . sliding door . pocket door",
    "floor_window": "floor to ceiling window . full height window . panoramic window",
    "normal_window": "window . casement window . small window . double hung window",
    "stove": "stove . gas stove . cooktop . induction stove . range",
    "sink": "sink . kitchen sink . bathroom sink . wash basin",
    "stairs": "staircase . stairs . stairway . indoor steps",
    "water_feature": "aquarium . fish tank . indoor fountain . indoor water feature",
    "broad_leaf_live": "broadleaf houseplant . monstera plant . fiddle leaf fig . tropical plant",
    "sharp_leaf_live": "spiky houseplant . cactus . snake plant . aloe vera . succulent",
    "fake_plant": "artificial plant . fake plant . faux plant . plastic plant . dried plant",
    "bed": "bed . bedroom bed . mattress . headboard bed",
    "sofa": "sofa . couch . sectional sofa . loveseat",
    "desk": "desk . office desk . study desk . computer desk . work table",
    "dining_table": "dining table . dining room table . kitchen table",
    "coffee_table": "coffee table . center table . low table",
    "mirror": "mirror . wall mirror . full length mirror . floor mirror",
    "beam": "ceiling beam . exposed beam . wooden beam . structural beam",
    "toilet": "toilet . bathroom toilet . commode",
    "cabinet": "storage cabinet . cabinet . wardrobe . cupboard . bookshelf cabinet",
}

# Merged training classes in output order, and the map into them.
MERGED_CLASSES = [
    "beam", "bed", "plant", "cabinet", "table", "window", "door", "mirror", "sink", "sofa",
    "stairs", "stove", "toilet", "water_feature",
]
MERGE_MAP = {
    "beam": "beam", "bed": "bed", "broad_leaf_live": "plant", "cabinet": "cabinet",
    "coffee_table": "table", "desk": "table", "dining_table": "table", "fake_plant": "plant",
    "floor_window": "window", "main_door": "door", "mirror": "mirror", "normal_window": "window",
    "room_door": "door", "sharp_leaf_live": "plant", "sink": "sink", "sofa": "sofa",
    "stairs": "stairs", "stove": "stove", "toilet": "toilet", "water_feature": "water_feature",
}

# Confusable groups, each with its own small classifier.
GROUPS = {
    "plant": ["broad_leaf_live", "fake_plant", "sharp_leaf_live"],
    "table": ["coffee_table", "dining_table"],
    "door": ["main_door", "room_door"],
    "window": ["floor_window", "normal_window"],
}

# (relabel_conf, relabel_margin, ambiguous_conf, ambiguous_margin) per group.
ACTION_LIMITS = {
    "plant": (0.82, 0.18, 0.58, 0.08),
    "door": (0.80, 0.16, 0.60, 0.10),
    "window": (0.80, 0.16, 0.60, 0.10),
    "table": (0.88, 0.22, 0.60, 0.08),
}
DEFAULT_LIMITS_GROUP = "door"

# Flags that send an image to human review.
CRITICAL_FLAGS = ["cross_class_duplicate", "empty_detection", "expected_missing"]

SCAN_SUFFIXES = ["jpg", "jpeg", "png", "webp"]
REVIEW_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "webp"]
DEDUPE_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "webp", "avif"]

TARGET_PER_CLASS = 1000
MIN_SHORT_SIDE = 512
MIN_BYTES = 20_000
MAX_WHITE_SHARE = 0.72
MAX_DARK_SHARE = 0.88
MIN_RED_STDEV = 8.0
LOW_SCORE = 0.35
BUSY_BOXES = 8
NMS_IOU = 0.5
MERGE_IOU = 0.98
NEAR_COSINE = 0.995
AREA_RANGE = (0.002, 0.95)
TOP_INSTANCES = 5
MIN_MASK_AREA = 256
CROP_PADDING = 0.08
FULL_THRESHOLD = 0.28
FALLBACK_THRESHOLD = 0.22

# ---- end of fixed values ---------------------------------------------------

FULL_PROMPT = " . ".join(PHRASES[name] for name in COLLECTION_CLASSES) + " ."


def classes(spark: SparkSession, names: list[str]) -> DataFrame:
    """(class_id, label) in the given order."""
    return spark.createDataFrame(list(enumerate(names)), "class_id int, label string")


def class_map(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """(class_id, source_class, target_class, target_id): source classes and what they merge into."""
    rows = [
        (i, name, MERGE_MAP[name], MERGED_CLASSES.index(MERGE_MAP[name]))
        for i, name in enumerate(names or REVIEW_CLASSES)
    ]
    return spark.createDataFrame(
        rows, "class_id int, source_class string, target_class string, target_id int"
    )


def groups(spark: SparkSession) -> DataFrame:
    """(group, label, class_index)."""
    rows = [(g, name, i) for g, names in GROUPS.items() for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "group string, label string, class_index int")


def pick(names: list[str], index: Column) -> Column:
    """Name at a position, or null when the position is outside the list."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def position(names: list[str], label: Column) -> Column:
    """Position of a name in the list; the list length when absent."""
    at = F.array_position(F.array(*[F.lit(n) for n in names]), label)
    return F.when(at == 0, F.lit(len(names))).otherwise(at - 1).cast("int")
