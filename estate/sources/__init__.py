"""Reading file trees and describe listings, writing result tables."""
