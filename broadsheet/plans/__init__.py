"""JB1-JB15: whole jobs composed of the operators."""
