"""The standard record, its vocabularies and the settings of a run."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

from pyspark.sql.types import StringType, StructField, StructType

# The columns of the standard record, in order.
STANDARD_COLUMNS = (
    "company_id",
    "name",
    "company_name",
    "website",
    "linkedin",
    "description",
    "industry",
    "size",
    "email",
    "phone",
    "facebook",
    "twitter",
    "instagram",
    "ceo",
    "founder",
    "source_used",
    "confidence_score",
    "status",
    "last_updated",
)
SOURCE_FILE = "_source_file"
STANDARD_SCHEMA = StructType([StructField(c, StringType()) for c in STANDARD_COLUMNS])
LOADED_SCHEMA = StructType([*STANDARD_SCHEMA.fields, StructField(SOURCE_FILE, StringType())])

# States of a record, and the fields that count for its score and for completeness.
STATUSES = ("FOUND", "PARTIALLY_FOUND", "NOT_FOUND", "NEEDS_REVIEW")
CRITICAL_FIELDS = ("name", "website", "description", "industry")
OPTIONAL_FIELDS = ("ceo", "founder", "size", "email", "phone", "linkedin", "facebook", "twitter", "instagram")
COMPLETENESS_FIELDS = ("name", "website", "description", "industry", "ceo", "founder", "email", "phone", "linkedin")

_SECRET = ("llm_api_key",)


@dataclass(frozen=True)
class Settings:
    """Settings with their ranges checked on creation. Paths are arguments of the sinks and sources, not of the logic."""

    llm_api_key: str = field(default="", repr=False)
    llm_model: str = ""
    llm_temperature: float = 0.0
    llm_max_tokens: int = 1024
    llm_requests_per_minute: int = 60
    request_timeout: int = 15
    max_retries: int = 3
    retry_backoff_factor: float = 1.5
    respect_robots: bool = True
    requests_per_second: float = 2.0
    min_confidence: int = 30
    partial_min: int = 60
    skip_found: bool = True
    max_text_chars: int = 8000
    max_prompt_tokens: int = 6000
    fuzzy_threshold: int = 90
    validation_threshold: int = 92
    cache_ttl_days: int = 7
    page_ttl_hours: int = 24
    score_cached: bool = True
    strict_redirect: bool = False
    single_export: bool = True
    token_vocabulary: str = ""
    output_dir: str = "output"

    def __post_init__(self):
        ranges = {
            "llm_temperature": (0, 2),
            "llm_max_tokens": (1, None),
            "llm_requests_per_minute": (1, None),
            "request_timeout": (1, None),
            "max_retries": (0, None),
            "retry_backoff_factor": (0, None),
            "requests_per_second": (0.1, None),
            "min_confidence": (0, 100),
            "partial_min": (0, 100),
            "max_text_chars": (500, None),
            "fuzzy_threshold": (1, 100),
            "validation_threshold": (1, 100),
            "cache_ttl_days": (0, None),
            "page_ttl_hours": (0, None),
        }
        for name, (low, high) in ranges.items():
            value = getattr(self, name)
            if value < low or (high is not None and value > high):
                raise ValueError(f"{name}={value} is outside {low} to {high if high is not None else 'any'}")

    @classmethod
    def from_env(cls, prefix: str = "LEDGERLOOM_") -> Settings:
        """Settings from environment variables such as LEDGERLOOM_FUZZY_THRESHOLD; the others keep their defaults."""
        kinds = {"int": int, "float": float, "str": str, "bool": lambda v: v.strip().lower() in ("1", "true", "yes", "on")}
        given = {f.name: os.environ[prefix + f.name.upper()] for f in fields(cls) if prefix + f.name.upper() in os.environ}
        return cls(**{f.name: kinds[f.type](given[f.name]) for f in fields(cls) if f.name in given})

    @property
    def llm_enabled(self) -> bool:
        return bool(self.llm_api_key.strip())

    def as_dict(self) -> dict:
        """All settings, secrets masked."""
        return {k: ("***" if k in _SECRET and v else v) for k, v in asdict(self).items()}

    def output_path(self, name: str) -> Path:
        out = Path(self.output_dir)
        out.mkdir(parents=True, exist_ok=True)
        return out / name
