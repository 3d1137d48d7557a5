"""Feature preprocessing as Spark ML estimators and transformers."""
