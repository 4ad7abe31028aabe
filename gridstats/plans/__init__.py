"""Jobs over the star schema: split, flatten, merge, analytic views."""
