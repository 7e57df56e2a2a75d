"""The one exception a feed raises, and the error codes a retry may cure."""

from __future__ import annotations

# Client and broker error codes after which the same slice may be retried.
# Any other code, also an unknown one, is final: retrying it would only hide it.
TRANSIENT_CODES = (
    "Local_Transport",
    "Local_TimedOut",
    "Local_AllBrokersDown",
    "BrokerNotAvailable",
    "LeaderNotAvailable",
    "NotLeaderForPartition",
    "RequestTimedOut",
    "Local_MsgTimedOut",
    "NetworkException",
    "NotEnoughReplicas",
    "NotEnoughReplicasAfterAppend",
    "Local_QueueFull",
    "GroupCoordinatorNotAvailable",
)


class FeedRefused(Exception):
    """A run stopped instead of skipping or altering data.

    ``transient`` says whether the same run may succeed when repeated unchanged.
    """

    def __init__(self, message: str, transient: bool = False):
        super().__init__(message)
        self.transient = transient
