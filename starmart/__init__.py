"""starmart: a conformed sales mart built with Spark DataFrames.

Several independently designed sales systems are mapped into one line-item
fact and five conformed dimensions; BI operators and quality checks work on
that star.
"""

from starmart.plans.star import Star
from starmart.sources.raw import RawZone
from starmart.sources.spec import Mapped, Source, SourceSpec

__all__ = ["Mapped", "RawZone", "Source", "SourceSpec", "Star"]
