"""epilake: case-record analytics as plain Spark DataFrame operators.

Raw event records are normalised, enriched with a keyed dimension, published
as date-partitioned Parquet, and turned into daily counts, running totals,
rates per population, latest-per-group rankings, monthly trends, binned
shares, outcome breakdowns, threshold dates, moving averages, a national
roll-up, and the bounded reads that serve them.

Every operator is ``DataFrame -> DataFrame``, takes its column names as
arguments and sets nothing global on the session.
"""

__version__ = "0.1.0"
