"""Cut-offs, layer paths and pipeline parameters."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

# Dataset version -> (registry snapshot month, order cut-off date).
DATASET_CUTOFFS = {
    "v1": ("202506", "2025-06-30"),
    "v2": ("202512", "2025-12-31"),
    "v3": ("202603", "2026-03-31"),
}
VALID_YEARS = (2000, 2026)
MAX_REJECT_RATE = 0.5
MIN_VALID_ID_SHARE = 0.95
SPLIT_SEED = 42
TEST_SHARE = 0.3
FOLDS = 5
ENCODING_WEIGHT = 100
RUN_PREFIX = "risk-run"


def cutoff_of(version: str) -> tuple[str, str]:
    """(month, date) of a dataset version; an unknown version is an error."""
    if version not in DATASET_CUTOFFS:
        raise ValueError(f"unknown dataset version {version!r}; known: {sorted(DATASET_CUTOFFS)}")
    return DATASET_CUTOFFS[version]


def parse_cutoffs(text: str | None = None) -> list[tuple[str, str]]:
    """Read ``"202506:2025-06-30,202512:2025-12-31"``.

    Nothing, blanks or the word ``todas`` select every known version.
    """
    cleaned = (text or "").strip()
    if cleaned.lower() in ("", "todas"):
        return list(DATASET_CUTOFFS.values())
    items = [item.strip() for item in cleaned.split(",")]
    found = [_CUTOFF.fullmatch(item) for item in items]
    bad = [item for item, match in zip(items, found) if match is None or not all(map(_is_day, (match[1] + "01", match[2])))]
    if bad:
        raise ValueError(f"bad cut-offs (expected yyyymm:yyyy-mm-dd): {bad}")
    return [(match[1], match[2]) for match in found]


_CUTOFF = re.compile(r"(\d{6}):(\d{4}-\d{2}-\d{2})")


def _is_day(text: str) -> bool:
    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


@dataclass(frozen=True)
class LakePaths:
    """Layer roots. With one shared root, layers become folders below it."""

    raw: str
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, root: str) -> "LakePaths":
        root = root.rstrip("/")
        return cls(*(f"{root}/{layer}" for layer in ("raw", "bronze", "silver", "gold")))

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}/{name}"

    @property
    def commits(self) -> str:
        """Where the numbered commit files of this lake are."""
        return f"{self.gold}/_commits"

    def quarantine(self, layer: str, name: str) -> str:
        # The silver quarantine is a first-level folder, so catalogues list it as a table.
        infix = "quarantine/" if layer == "bronze" else "quarantine_"
        return f"{getattr(self, layer)}/{infix}{name}"


def staging_path(live: str) -> str:
    """``scheme://bucket/key`` -> ``scheme://bucket/_staging/key``; plain paths likewise."""
    if "://" in live:
        scheme, rest = live.split("://", 1)
        bucket, _, key = rest.partition("/")
        return f"{scheme}://{bucket}/_staging/{key}"
    head, _, tail = live.rstrip("/").rpartition("/")
    return f"{head}/_staging/{tail}"
