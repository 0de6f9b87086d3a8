"""Tables, schemas and the adapters from raw tables to staging frames."""
