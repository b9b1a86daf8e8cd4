"""Jobs on posts that keep arriving."""
