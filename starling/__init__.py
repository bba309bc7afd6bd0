"""starling: social-media ingestion, labelling, curation and analytics jobs on Spark."""
