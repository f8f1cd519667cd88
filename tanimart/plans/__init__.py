"""Whole plans: the similarity chain, the mart and its views."""
