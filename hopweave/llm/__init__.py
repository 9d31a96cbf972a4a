"""Operators of a training-data pipeline over text corpora (see README, "Training-data operators")."""
