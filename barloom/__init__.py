"""Bar analytics, back-testing and data preparation as lazy Spark plans."""
