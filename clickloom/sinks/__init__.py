"""Writers: appended results, and tables built from numbered batches."""
