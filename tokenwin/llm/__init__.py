"""Operators of a pipeline that prepares text for training language models."""
