"""No operators: every job here is bounded, as are those it stands in for."""
