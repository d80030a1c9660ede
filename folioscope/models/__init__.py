"""Model stages: recognisers and classifiers that are plugged in, or replayed from recorded output."""
