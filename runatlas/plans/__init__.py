"""End-to-end plans: ETL, warehouse, analytical views, driver-table adapter."""
