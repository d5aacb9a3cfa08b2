"""Column builders: ``Column -> Column`` helpers, all JVM-side expressions."""

from featureflow.functions.bbox import bbox_ok, bbox_parts
from featureflow.functions.hashing import cut_points, split_bucket, split_label
from featureflow.functions.labels import EMOTION_CODES, UNKNOWN_CODE, label_code, mapping_literal
from featureflow.functions.paths import (
    IMAGE_ID_PATTERN,
    base_name,
    extension,
    image_id,
    image_path,
    is_visible_file,
    joined_path,
    normalized_name,
    parent_folder,
    stem,
    strip_scheme,
)
from featureflow.functions.vectors import LOG_EPS, argmax, log_loss_term, prob_at, rounded

__all__ = [
    "EMOTION_CODES", "IMAGE_ID_PATTERN", "LOG_EPS", "UNKNOWN_CODE", "argmax", "base_name", "bbox_ok",
    "bbox_parts", "cut_points", "extension", "image_id", "image_path", "is_visible_file", "joined_path",
    "label_code", "log_loss_term", "mapping_literal", "normalized_name", "parent_folder", "prob_at", "rounded",
    "split_bucket", "split_label", "stem", "strip_scheme",
]
