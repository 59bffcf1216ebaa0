"""DataFrame-to-DataFrame operators. Nothing here collects rows; run dates are arguments."""
