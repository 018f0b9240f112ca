"""Writers: namespaces, tables, day partitions and exports."""
