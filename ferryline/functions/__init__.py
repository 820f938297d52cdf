"""Column-level helpers: expression functions, named transforms, record paths."""
