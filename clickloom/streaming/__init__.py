"""Streaming queries over the ad log."""
