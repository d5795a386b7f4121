"""tillroll: a Spark-native retail sales warehouse.

Layers (raw text -> typed staging -> star schema -> KPI views -> analyses),
a raw-data quality profile and a validation suite, all expressed with the
DataFrame API so Catalyst and AQE plan them.
"""

__version__ = "0.1.0"
