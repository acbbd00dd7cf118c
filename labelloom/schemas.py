"""Schemas and default parameters."""

from __future__ import annotations

# The default class dictionary, splits, ratios and cuts. All are arguments where they are used.
CLASSES = {0: "Bacterial_Leaf_Blight", 1: "Brown_Spot"}
CLASS_ALIASES = {
    "bacterial leaf blight": "Bacterial_Leaf_Blight",
    "bacterial leafblight": "Bacterial_Leaf_Blight",
    "brown spot": "Brown_Spot",
    "brownspot": "Brown_Spot",
}
LOCAL_NAMES = {0: "Bạc lá lúa", 1: "Đốm nâu"}
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")
SPLIT_DIRS = ("train", "valid", "val", "test")
RATIOS = {"train": 0.70, "val": 0.15, "test": 0.15}
SEED = 42
MIN_GROUPS = {"train": 10, "val": 5, "test": 5}
MIN_BOXES = {"val": 20, "test": 20}
SIZES = ("small", "medium", "large")
TOLERANCE = 1e-6
MAX_BYTES, MAX_PIXELS = 10 * 1024 * 1024, 25_000_000

LABEL_LINES = "image_id long, source string, line_no int, line string"
CLASS_MAP = "source string, old_id double, class_id int"
TRUTH = "image_id long, gt_idx int, class_id int, x1 double, y1 double, x2 double, y2 double"
DETECTIONS = "image_id long, pred_idx int, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double"
# The columns of a manifest.
MANIFEST = (
    "image_id string, source_image_id string, split string, source string, old_split string, group_id string, original_key string, "
    "output_image string, source_image string, sha256 string, phash string, width int, height int, annotation_status string, "
    "is_negative boolean, instances_class_0 int, instances_class_1 int"
)
