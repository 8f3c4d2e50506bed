"""vulnlake: a PySpark analytics library for nested vulnerability-advisory documents.

Documents (JSON) -> bronze (one row per document, nested parts as JSON text) -> silver (``core_cves`` and
``affected_products``) -> gold reports, all as DataFrame operators on built-in Spark functions.
"""

__version__ = "0.1.0"
