"""Turn a corpus of web pages into tables, ratings and weighted reports on Spark."""
