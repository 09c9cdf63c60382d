"""Column -> Column building blocks. Everything here stays inside Catalyst."""
