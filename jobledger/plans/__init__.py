"""Session settings and the join and aggregation shapes that keep hot keys spread out."""
