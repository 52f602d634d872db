"""Corpora, query and judgement files, and the tables of the offline half."""
