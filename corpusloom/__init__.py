"""Text-frequency analytics over corpora, on Spark."""
