"""Readers and writers of episodes, ranges, statistics, records and codecs."""
