"""millrace: a Spark-native engine that prepares text corpora for language-model training."""

__version__ = "0.1.0"
