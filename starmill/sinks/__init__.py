"""Writers and load modes."""
