"""Analytics over sparse volumes, sampling plans and corpora, expressed as Spark DataFrame operations."""
