"""Writers: file datasets in every supported format, catalog and JDBC tables."""
