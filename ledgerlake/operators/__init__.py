"""ledgerlake subpackage."""
