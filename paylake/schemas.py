"""Schemas of the raw inputs. Amounts stay text until Silver, so no malformed value is lost early."""

DETAIL = """struct<
    id: string, event: string, version: string, eventType: string, transactionType: string, eventEntity: string,
    eventStatus: string,
    payload: struct<
        userId: string, name: string, age: int, email: string, city: string, segment: string, timestamp: string,
        accountId: string, amount: string, currency: string, merchant: string, category: string,
        paymentMethod: string, installments: string, balanceBefore: string, balanceAfter: string,
        initialBalance: string, status: string, source: string,
        location: struct<city: string, country: string>,
        updatedFields: struct<city: string, segment: string>>,
    metadata: struct<device: string, os: string, ip: string, channel: string>>"""

RAW_EVENT = f"source string, detailType string, detail {DETAIL}"
CORRUPT = "_corrupt_record"  # text of a line that is not JSON

# Any message as it arrives: nested parts are read as their JSON text.
MESSAGE = """msg_type string, source string, schema_version string, message_id string, timestamp string,
    data string, metadata string, detailType string, detail string"""

# What duplicate detection needs of stored Bronze.
BRONZE_IDS = "event_id string, batch_id string, ingestion_timestamp string, source_file string"

# Bronze column <- path below ``detail``; order is the Bronze column order.
FLAT_PATHS = {
    "event_id": "id", "event": "event", "event_version": "version", "event_type": "eventType",
    "transaction_type": "transactionType", "event_entity": "eventEntity", "event_status": "eventStatus",
    "user_id": "payload.userId", "user_name": "payload.name", "user_age": "payload.age",
    "user_email": "payload.email", "user_city": "payload.city", "user_segment": "payload.segment",
    "timestamp": "payload.timestamp", "account_id": "payload.accountId", "amount": "payload.amount",
    "currency": "payload.currency", "merchant": "payload.merchant", "category": "payload.category",
    "payment_method": "payload.paymentMethod", "installments": "payload.installments",
    "balance_before": "payload.balanceBefore", "balance_after": "payload.balanceAfter",
    "initial_balance": "payload.initialBalance", "account_status": "payload.status",
    "money_source": "payload.source", "location_city": "payload.location.city",
    "location_country": "payload.location.country", "updated_city": "payload.updatedFields.city",
    "updated_segment": "payload.updatedFields.segment", "device": "metadata.device", "os": "metadata.os",
    "ip": "metadata.ip", "channel": "metadata.channel",
}
