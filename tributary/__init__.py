"""tributary: multi-touch marketing attribution on Spark DataFrames."""

from .config import AttributionConfig, ConversionEvent, FIXTURE_CONFIG

__all__ = ["AttributionConfig", "ConversionEvent", "FIXTURE_CONFIG"]
__version__ = "0.1.0"
