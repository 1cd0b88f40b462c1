"""DataFrame → DataFrame operators of the recommenders."""
