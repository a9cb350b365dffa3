"""Plans over the operators: landing a batch, fixtures, registered queries."""
