"""The daily models composed from the operators: staging, warehouse, marts, reports."""
