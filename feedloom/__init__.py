"""Feedloom: feed-recommendation data jobs as Spark DataFrame and Structured Streaming plans."""
