"""DataFrame transformations, usable on batch and stream inputs alike."""
