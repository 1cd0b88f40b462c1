"""Composed plans: the registered queries (``catalog``) and the three
end-to-end recommenders (``recommenders``)."""
