"""corpusloom: text corpus curation and analytics as declarative Spark plans."""
