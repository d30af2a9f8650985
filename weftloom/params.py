"""Thresholds and sizes of a curation run, with the two published presets."""

from dataclasses import dataclass

# They must equal the published defaults for results to agree.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp")
SKIPPED_HREF_PREFIXES = ("javascript:", "mailto:", "tel:", "#", "data:")
IMG_ATTRIBUTES = ("src", "data-src", "data-lazy-src", "data-original", "data-image", "data-full")
IMAGE_URL_PATTERN = r"(?i)\.(jpe?g|png|webp)(\?|$)"
CODE_FENCE_PATTERN = r"```(?:json)?\s*|\s*```"
PERSON_QUESTION = "Does this image contain a visible person? Respond only YES or NO."


@dataclass(frozen=True)
class CurationParams:
    # Fixed values as well: the published defaults.
    min_image_dim: int = 500
    batch_size: int = 300
    score_batch_size: int = 50
    score_min: float = 0.6
    hash_distance: int = 8
    histogram_min: float = 0.98
    ssim_high: float = 0.92
    ssim_review_low: float = 0.80
    embedding_min: float = 0.97
    rank_min: float = 0.55
    keep_min: float = 0.75
    review_min: float = 0.50


SCRIPT_PRESET = CurationParams()
NOTEBOOK_PRESET = CurationParams(rank_min=0.70)
