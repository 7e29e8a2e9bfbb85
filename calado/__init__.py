"""DataFrame operators for corridor studies and public statistics."""
