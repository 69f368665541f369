"""Check inputs and check queries; not part of the library."""
