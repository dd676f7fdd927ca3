"""Message views over the given tables.

One SQL text serves Spark and DuckDB.  ``{rows}`` yields n, ts, user_id, kind, value, props.
"""

EVENT_ROWS = "SELECT event_id AS n, ts, user_id, event_type AS kind, value, props FROM events"
LINEITEM_ROWS = (
    "SELECT l_orderkey * 10 + l_linenumber AS n, l_shipdate AS ts, l_suppkey AS user_id,"
    " CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'view' END AS kind, l_extendedprice AS value,"
    " l_returnflag AS props FROM lineitem"
)

MESSAGES_SQL = """
SELECT n AS MTMessageId,
       concat('57300', lpad(cast(user_id AS string), 7, '0')) AS PhoneNumber,
       CASE WHEN kind = 'error' THEN 1 ELSE 3 END AS StatusId,
       ts AS ArrivalDate,
       CASE WHEN n % 50 = 1 THEN NULL
            WHEN b = 0 THEN 'Bancolombia' WHEN b = 1 THEN 'BBVA' WHEN b IN (2, 10) THEN 'Davivienda'
            WHEN b IN (3, 9) THEN 'WhatsApp' WHEN b IN (4, 16) THEN 'Nequi' WHEN b = 5 THEN 'EAAB'
            WHEN b = 6 THEN 'Celsia' WHEN b = 7 THEN 'Seguros Mundial' WHEN b = 8 THEN 'Telegram'
            WHEN b = 12 THEN 'Famisanar'
            WHEN b = 13 AND n % 3 = 0 THEN 'Temu' WHEN b = 13 AND n % 3 = 1 THEN 'SHEIN'
            WHEN b = 13 THEN 'Tienda' WHEN b = 17 THEN 'Bancolombia' ELSE 'Otros' END AS ClientName,
       b AS ClientId,
       1 + n % 3 AS PriorityId,
       CASE n % 3 WHEN 0 THEN 'Alto' WHEN 1 THEN 'Normal' ELSE 'Bajo' END AS PriorityDescription,
       CASE WHEN n % 40 = 3 THEN NULL WHEN user_id % 4 = 0 THEN 'Claro' WHEN user_id % 4 = 1 THEN 'Movistar'
            WHEN user_id % 4 = 2 THEN 'Tigo' ELSE 'WOM' END AS OperatorName,
       concat('acc', cast(user_id % 10 AS string)) AS AccountName,
       props AS Variables,
       CASE b
         WHEN 0 THEN concat('Bancolombia: compra por $', a, ' el ', dd, '/', mm, '/', yy, ' a las ', hh, ':', mi, '.')
         WHEN 1 THEN concat('  BBVA   saldo   disponible $', a, '  ')
         WHEN 2 THEN concat('Tu clave Davivienda es ', c)
         WHEN 3 THEN concat('Tu codigo de verificacion es ', c)
         WHEN 4 THEN 'Acabas de entrar a la app de Nequi desde www.x.co'
         WHEN 5 THEN concat('La EAAB informa que su factura esta lista: https://eaab.co/', k)
         WHEN 6 THEN concat('Celsia: factura ', k, ' en https://c.co/p')
         WHEN 7 THEN concat('Seguros Mundial activar SOAT ', k, ' hoy')
         WHEN 8 THEN concat('Telegram code ', c, ' log in https://t.me/x')
         WHEN 9 THEN concat('WhatsApp codigo ', c)
         WHEN 10 THEN 'Davivienda opciones de pago para tarjeta de credito'
         WHEN 11 THEN concat('Llama al 3001234567 con tu pin ', c)
         WHEN 12 THEN 'Famisanar cita el 14 de marzo de 2024 9:00 a.m.'
         WHEN 13 THEN 'Descuento del 50% en toda la tienda'
         WHEN 14 THEN 'gracias por su visita'
         WHEN 15 THEN concat('Referencia ', k, ' tasa 3.5% y 2024/01/03')
         WHEN 16 THEN concat('Nequi clave ', c, ' tarjeta de credito')
         WHEN 17 THEN 'Bancolombia transferencia desde cuenta de ahorros'
         ELSE 'Su opinion vale 2500 puntos' END AS Message
FROM (
  SELECT n, ts, user_id, kind, props,
         CASE WHEN n % 5 = 0 THEN 14 ELSE (n * 7 + user_id) % 19 END AS b,
         cast(cast(floor(value) AS bigint) AS string) AS a,
         cast(n AS string) AS k,
         cast(100000 + n AS string) AS c,
         lpad(cast(day(ts) AS string), 2, '0') AS dd,
         lpad(cast(month(ts) AS string), 2, '0') AS mm,
         cast(year(ts) AS string) AS yy,
         lpad(cast(hour(ts) AS string), 2, '0') AS hh,
         lpad(cast(minute(ts) AS string), 2, '0') AS mi
  FROM ({rows}) src
) s
"""


def messages_sql(rows: str = EVENT_ROWS) -> str:
    return MESSAGES_SQL.replace("{rows}", rows)
