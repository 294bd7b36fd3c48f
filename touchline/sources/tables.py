"""Container for the four raw (bronze) source tables."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RawTables:
    """The raw layer: faithful copies of the four sources, no cleaning.

    ``provenance`` maps each raw table name to the file(s) it was read from,
    which is what the ingest manifest reports.
    """

    campaign_metadata: DataFrame
    content_performance: DataFrame
    user_signups: DataFrame
    portfolio_revenue: DataFrame
    provenance: dict[str, str] = field(default_factory=dict)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [
            ("raw_campaign_metadata", self.campaign_metadata),
            ("raw_content_performance", self.content_performance),
            ("raw_portfolio_revenue", self.portfolio_revenue),
            ("raw_user_signups", self.user_signups),
        ]
