"""Registered query plans (each reads the driver tables) and the staged
video-analytics job (preprocess -> train -> infer)."""
