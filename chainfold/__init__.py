"""chainfold: DataFrame operators for daily token-transfer tables.

Layers: a label step turns raw transfers into labelled rows, the bronze
layer lands a day of them as files, silver cleans and merges them into a
year/month partitioned table, gold aggregates each month per week, and
top-k answers the final questions. Every operator takes and returns
DataFrames and changes no session configuration.
"""

__version__ = "0.1.0"
